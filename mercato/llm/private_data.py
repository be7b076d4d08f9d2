"""Private data: detected entities get keyed surrogates of the same type, script and format.

Entities are found with one regular expression; words of the names found after titles are found
again wherever else the same document has them.  Each is reduced to a canonical form (digits
of a phone or card number, lower-case e-mail, single words of a person's name), so that all
its spellings are one entity, and gets one surrogate form from a keyed digest: digits for
digits, letters for letters of the same script, given names by the gender of the title, cards
with a valid check digit, addresses with octets in range.  Surrogates that two entities share,
or that are themselves an entity of the table, are drawn again until none is; so entities stay
distinct, every mention of one reads alike, and no real value takes another's place.  The
surface format (case, separators, brackets) is then filled with the surrogate's characters.

Only built-in functions run on the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pinned

MAX_ROUNDS = 50

# fixed values: titles that lead a name, by the gender they state
TITLES = {"m": ["Mr", "Mister", "Sir", "Lord", "Herr", "Monsieur", "Señor", "Sr", "Don", "Senhor", "Signor", "Sig",
                "Господин", "господин", "Г-н", "г-н", "Пан", "пан", "Κύριος", "κύριος", "Κος", "κ", "Պարոն", "պարոն"],
          "f": ["Mrs", "Ms", "Miss", "Lady", "Dame", "Frau", "Madame", "Mme", "Mademoiselle", "Mlle", "Señora", "Señorita", "Sra", "Srta",
                "Doña", "Senhora", "Signora", "Госпожа", "госпожа", "Г-жа", "г-жа", "Пани", "пани", "Κυρία", "κυρία", "Κα", "κα",
                "Տիկին", "տիկին"],
          "n": ["Dr", "Prof", "Doctor", "Professor", "Доктор", "доктор", "Д-р", "д-р", "Профессор", "профессор", "Проф", "проф",
                "Δρ", "Καθηγητής", "Καθηγήτρια", "Դոկտոր", "դոկտոր", "Պրոֆեսոր", "պրոֆեսոր"]}
# fixed values: endings of surrogate given names, by script and gender
ENDINGS = {"latin": {"m": ["n", "r", "s", "k"], "f": ["a", "ia", "e", "ina"], "n": ["y", "is", "o", "en"]},
           "cyrillic": {"m": ["н", "р", "с", "к"], "f": ["а", "ия", "я", "ина"], "n": ["о", "и", "е", "ен"]},
           "greek": {"m": ["νος", "ρης", "σος", "κης"], "f": ["α", "ια", "η", "ινα"], "n": ["ω", "ι", "ε", "εν"]},
           "armenian": {"m": ["ն", "ր", "ս", "կ"], "f": ["ա", "իա", "ե", "ինա"], "n": ["ո", "ի", "ե", "են"]}}
SYLLABLES = {"latin": ("bdfgklmnprstvz", "aeiou"), "cyrillic": ("бвгдклмнпрст", "аеиоу"),
             "greek": ("βγδζκλμνπρστφχ", "αεηιουω"), "armenian": ("բգդզկլմնպրստվ", "աեիո")}
# fixed values: words in small letters within names
PARTICLES = ["de la", "de las", "de los", "de", "del", "della", "di", "da", "das", "dos", "do", "du", "des", "van der", "van den", "van de",
             "van", "von der", "von", "vom", "zu", "zur", "ter", "ten", "den", "der", "le", "la", "el", "al", "bin", "ibn", "bint", "af", "av", "y", "e"]

_NAME = r"\p{Lu}(?:[\p{L}\p{M}-]|['’](?!s(?![\p{L}\p{M}])))*"
_INITIALS = r"(?:\p{Lu}\.)+"
_LEAD = rf"(?:{_INITIALS}[ ]?|(?:{'|'.join(PARTICLES)})[ ]|(?:d|l|D|L)['’](?=\p{{Lu}}))"
_TITLE = "|".join(t for ts in TITLES.values() for t in ts)
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
PATTERNS = {
    "email": r"(?<![\w.%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "secret": r"(?<!\w)(?i:password|passwd|secret|token|api[_-]?key)[ \t]{0,3}[=:][ \t]{0,3}[\"']?[A-Za-z0-9_+/-]{8,}"
              r"|(?<!\w)AKIA[0-9A-Z]{16}(?!\w)|(?<!\w)[0-9a-f]{32,}(?!\w)",
    "ip": rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?![\w]|\.\d)",
    "card": r"(?<![\w+])\d(?:[ -]?\d){12,18}(?!\w)",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,3}|\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}"
             r"|\d{3}[.-]\d{3}[.-]\d{4})(?!\w)",
    "national_id": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "person": rf"(?<!\w)(?:{_TITLE})\.?[ ]{_LEAD}{{0,6}}{_NAME}(?:[ ]{_LEAD}{{0,4}}{_NAME}){{0,2}}",
}
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS.values())
_DIGITS = ["phone", "card", "national_id"]


def may_hold(text: Column) -> Column:
    """False only for texts without any entity: no digit, @, sign or key of a secret, and no title before a word."""
    out = text.rlike("[0-9@=:]") | text.contains("AKIA") | text.rlike("[a-f]{32}")
    for titles in TITLES.values():
        for t in titles:
            out = out | text.contains(f"{t} ") | text.contains(f"{t}. ")
    return F.coalesce(out, F.lit(False))


def kind_of(entity: Column) -> Column:
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(PATTERNS.items()):
        out = F.when(entity.rlike(f"^(?:{pattern})$"), F.lit(kind)).otherwise(out)
    return out


def _draw(key: str, i: Column, n: int) -> Column:
    """A keyed number below ``n`` for an entity, its attempt and a position."""
    digest = F.sha2(F.concat_ws("\x1f", F.lit(key), F.col("kind"), F.col("canonical"), F.col("attempt").cast("string"), i.cast("string")), 256)
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") % n).cast("int")


def _pick(chars: str, at: Column) -> Column:
    return F.substring(F.lit(chars), at + 1, F.lit(1))


def _characters(key: str) -> Column:
    """Another character of the same class for every character of the canonical form."""
    def one(i: Column) -> Column:
        c = F.substring(F.col("canonical"), i, F.lit(1))
        return (F.when((i == 1) & c.rlike("[0-9]"), _pick("123456789", _draw(key, i, 9)))
                .when(c.rlike("[0-9]"), _pick("0123456789", _draw(key, i, 10)))
                .when(c.rlike("[a-f]") & (F.col("kind") == "secret"), _pick("abcdef", _draw(key, i, 6)))
                .when(c.rlike("[a-z]"), _pick("abcdefghijklmnopqrstuvwxyz", _draw(key, i, 26)))
                .when(c.rlike("[A-Z]"), _pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", _draw(key, i, 26))).otherwise(c))
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length("canonical")), one), "")


def _octets(key: str) -> Column:
    return F.concat_ws(".", *[(_draw(key, F.lit(i), 223) + 1).cast("string") for i in range(4)])


def _checked(digits: Column) -> Column:
    """A card number with its last digit set so that the Luhn sum is right."""
    n = F.length(digits)
    def term(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(i % 2 == 1, d * 2).otherwise(d)
        return F.when(twice > 9, twice - 9).otherwise(twice)
    total = F.aggregate(F.sequence(F.lit(1), n - 1), F.lit(0), lambda a, i: a + term(i))
    return F.concat(F.substring(digits, F.lit(1), n - 1), ((10 - total % 10) % 10).cast("string"))


def _name(key: str, script: str, ending: str | None) -> Column:
    consonants, vowels = SYLLABLES[script]
    count = 2 + F.col("attempt") % 3 + _draw(key, F.lit("len"), 2)
    body = F.array_join(F.transform(F.sequence(F.lit(1), count), lambda i: F.concat(
        _pick(consonants, _draw(key, i * 2, len(consonants))), _pick(vowels, _draw(key, i * 2 + 1, len(vowels))))), "")
    if ending is None:
        return F.concat(body, _pick(consonants, _draw(key, F.lit("end"), len(consonants))))
    ends = ENDINGS[script][ending]
    return F.concat(body, F.array(*map(F.lit, ends))[_draw(key, F.lit("end"), len(ends))])


def script_of(word: Column) -> Column:
    out = F.lit("latin")
    for script in ("armenian", "greek", "cyrillic"):
        out = F.when(word.rlike(rf"\p{{Is{script.capitalize()}}}"), F.lit(script)).otherwise(out)
    return out


def surrogate_of(key: str) -> Column:
    """The surrogate form of (kind, canonical, attempt)."""
    out = _characters(key)
    out = F.when(F.col("kind") == "ip", _octets(key)).when(F.col("kind") == "card", _checked(_characters(key))).otherwise(out)
    for script in SYLLABLES:
        mine = script_of(F.col("canonical")) == script
        for kind, ending in (("surname", None), ("given_m", "m"), ("given_f", "f"), ("given_n", "n")):
            out = F.when((F.col("kind") == kind) & mine, _name(key, script, ending)).otherwise(out)
    return out


def distinct_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canonical, surrogate) for distinct (kind, canonical): no surrogate twice in a kind, none that is an entity."""
    # a surrogate costs far more than its row's bytes suggest, so partitions aren't merged by size
    parts = int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    entities = pinned(entities.repartition(parts, "kind", "canonical"))
    now = pinned(entities.withColumn("attempt", F.lit(0)).withColumn("surrogate", surrogate_of(key)))
    for _ in range(MAX_ROUNDS):
        first = now.groupBy("kind", "surrogate").agg(F.min("canonical").alias("_first"), F.count("*").alias("_n"))
        taken = entities.select("kind", F.col("canonical").alias("surrogate"), F.lit(True).alias("_real"))
        clash = pinned(first.join(taken, ["kind", "surrogate"], "left").filter("_n > 1 or _real"))
        if clash.isEmpty():
            return now.select("kind", "canonical", "surrogate")
        again = F.col("_n").isNotNull() & (F.coalesce("_real", F.lit(False)) | (F.col("canonical") != F.col("_first")))
        now = pinned(now.join(clash, ["kind", "surrogate"], "left")
                     .withColumn("attempt", F.col("attempt") + F.when(again, 1).otherwise(0))
                     .select("kind", "canonical", "attempt").withColumn("surrogate", surrogate_of(key)))
    raise RuntimeError(f"no distinct surrogates after {MAX_ROUNDS} rounds")


def _part(kind: Column, canonical: Column, surface: Column) -> Column:
    return F.struct(kind.alias("kind"), canonical.alias("canonical"), surface.alias("surface"))


def _plain(surface: Column) -> Column:
    return _part(F.lit(None).cast("string"), F.lit(None).cast("string"), surface)


def _initials(word: Column, key: str) -> Column:
    """Other initials: letters are too few to keep each distinct."""
    def one(c: Column, i: Column) -> Column:
        out = c
        for script, (consonants, _) in SYLLABLES.items():
            digest = F.conv(F.substring(F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit("initial"), c), 256), 1, 12), 16, 10).cast("long")
            n = len(consonants)
            at = (digest % n).cast("int")
            # never the letter itself
            at = F.when(_pick(consonants, at) == F.lower(c), (at + 1) % n).otherwise(at)
            out = F.when((c != ".") & (script_of(c) == script), F.upper(_pick(consonants, at))).otherwise(out)
        return out
    return F.array_join(F.transform(F.split(word, ""), one), "")


def person_parts(entity: Column, key: str) -> Column:
    """A name after its title as parts: title, spaces and particles stay; the last name is the surname."""
    words = F.regexp_extract_all(entity, F.lit(rf"[ ]|{_INITIALS}|[dlDL]['’](?=\p{{Lu}})|[^ .]+\.?"), F.lit(0))
    title = F.regexp_replace(F.regexp_extract(entity, r"^([^ ]+)", 1), r"\.$", "")
    gender = F.when(title.isin(TITLES["m"]), "m").when(title.isin(TITLES["f"]), "f").otherwise("n")
    def word(ws: Column, w: Column, i: Column) -> Column:
        own = F.when(i == F.size(ws) - 1, F.lit("surname")).otherwise(F.concat(F.lit("given_"), gender))
        return (F.when((i == 0) | (w == " "), _plain(w)).when(w.rlike(rf"^{_INITIALS}$"), _plain(_initials(w, key)))
                .when(w.rlike(r"^\p{Lu}") & ~w.rlike("^[dlDL]['’]$"), _part(own, F.lower(w), w)).otherwise(_plain(w)))
    return F.transform(F.array(words), lambda ws: F.transform(ws, lambda w, i: word(ws, w, i)))[0]


def names_of(text: Column, key: str) -> Column:
    """The distinct words of the names that follow titles: (kind, canonical), surnames first."""
    titled = F.regexp_extract_all(text, F.lit(PATTERNS["person"]), F.lit(0))
    words = F.filter(F.flatten(F.transform(titled, lambda e: person_parts(e, key))), lambda p: p["kind"].isNotNull() & (F.length(p["surface"]) > 1))
    return F.sort_array(F.array_distinct(words), asc=False)


def entity_pattern(names: Column) -> Column:
    """The entities, and further mentions of the names: as written, in capitals, or with a capital."""
    forms = F.array_distinct(F.flatten(F.transform(names, lambda p: F.array(p["surface"], F.upper(p["surface"]), F.initcap(p["canonical"])))))
    longest = F.transform(F.sort_array(F.transform(forms, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))), asc=False), lambda x: x["w"])
    one = F.concat(F.lit("(?:"), F.array_join(longest, "|"), F.lit(")"))
    mention = F.concat(F.lit(r"(?<![\p{L}\p{M}\p{N}'’-])"), one, F.lit("(?:[ ]"), one, F.lit(r"){0,3}(?![\p{L}\p{M}\p{N}-])"))
    return F.when(F.size(names) > 0, F.concat(F.lit(ENTITY + "|"), mention)).otherwise(F.lit(ENTITY))


def _parts(entity: Column, kind: Column, names: Column, key: str) -> Column:
    """An entity as parts: (kind, canonical, surface); a null kind marks text that stays."""
    head = F.regexp_extract(entity, r"^(.*[=:][ \t]{0,3}[\"']?)", 1)
    secret = F.substring(entity, F.length(head) + 1, F.length(entity))
    def again(w: Column) -> Column:
        known = F.filter(names, lambda p: p["canonical"] == F.lower(w))
        return F.when(w == " ", _plain(w)).otherwise(_part(F.get(known, F.lit(0))["kind"], F.lower(w), w))
    mentions = F.transform(F.regexp_extract_all(entity, F.lit("[ ]|[^ ]+"), F.lit(0)), again)
    return (F.when(kind == "person", person_parts(entity, key)).when(kind == "mention", mentions)
            .when(kind == "secret", F.array(_plain(head), _part(kind, secret, secret)))
            .when(kind.isin(_DIGITS), F.array(_part(kind, F.regexp_replace(entity, r"\D", ""), entity)))
            .otherwise(F.array(_part(kind, F.lower(entity), entity))))


def _filled(surface: Column, surrogate: Column, kind: Column) -> Column:
    """The surrogate in the format of the surface: its separators, its capitals."""
    digits = F.array_join(F.transform(
        F.sequence(F.lit(1), F.length(surface)),
        lambda i: F.when(F.substring(surface, i, F.lit(1)).rlike("[0-9]"), F.substring(
            surrogate, F.length(F.regexp_replace(F.substring(surface, F.lit(1), i), r"\D", "")), F.lit(1)))
        .otherwise(F.substring(surface, i, F.lit(1)))), "")
    cased = F.when(surface == F.upper(surface), F.upper(surrogate)).otherwise(
        F.concat(F.upper(F.substring(surrogate, 1, 1)), F.substring(surrogate, F.lit(2), F.length(surrogate))))
    email = F.when(surface == F.lower(surface), surrogate).otherwise(F.array_join(F.transform(
        F.sequence(F.lit(1), F.length(surface)),
        lambda i: F.when(F.substring(surface, i, F.lit(1)).rlike(r"\p{Lu}"), F.upper(F.substring(surrogate, i, F.lit(1))))
        .otherwise(F.substring(surrogate, i, F.lit(1)))), ""))
    return (F.when(kind.isNull(), surface).when(kind.isin(_DIGITS), digits)
            .when(kind.startswith("given_") | (kind == "surname"), cased).when(kind == "email", email).otherwise(surrogate))


def replace_private_data(docs: DataFrame, key: str) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): doc_id, n_entities, kinds, text with surrogates.

    ``kinds`` lists the kinds found, in order of text.  Null texts stay null and texts without
    entities stay as they are; rows that repeat both id and text get the same text.  Other columns
    are ignored.  The same key gives the same surrogates for the same set of entities."""
    rows = docs.select("doc_id", "text", may_hold(F.col("text")).alias("_hint"))
    clean = rows.filter("not _hint").select(
        "doc_id", F.lit(0).alias("n_entities"), F.array().cast("array<string>").alias("kinds"), "text")
    rows = rows.filter("_hint").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), F.xxhash64("text").alias("_h"),
        F.length("text").alias("_len"), "doc_id", "text", names_of(F.col("text"), key).alias("_names")) \
        .withColumn("_pattern", entity_pattern(F.col("_names")))
    row = ["_id", "_h", "_len"]
    found = rows.select(*row, "_names", F.posexplode(F.regexp_extract_all("text", F.col("_pattern"), F.lit(0))).alias("pos", "entity"))
    found = found.withColumn("kind", F.coalesce(kind_of(F.col("entity")), F.lit("mention")))
    of = F.when(F.col("kind") == "mention", "person").otherwise(F.col("kind"))
    parts = pinned(found.select(*row, "pos", of.alias("of"), F.posexplode(_parts(F.col("entity"), F.col("kind"), F.col("_names"), key)).alias("k", "p"))
                   .select(*row, "pos", "of", "k", "p.kind", "p.canonical", "p.surface"))
    table = distinct_surrogates(parts.filter("kind is not null").select("kind", "canonical").distinct(), key)
    table = table.select(F.col("kind").alias("_kind"), F.col("canonical").alias("_canonical"), "surrogate")
    written = parts.join(table, (F.col("kind") == F.col("_kind")) & (F.col("canonical") == F.col("_canonical")), "left") \
        .withColumn("new", _filled(F.col("surface"), F.col("surrogate"), F.col("kind")))
    entities = written.groupBy(*row, "pos", "of").agg(F.array_sort(F.collect_set(F.struct("k", "new"))).alias("ks"))
    by_row = entities.groupBy(*row).agg(F.array_sort(F.collect_list(F.struct(
        "pos", F.array_join(F.col("ks.new"), "").alias("new"), "of"))).alias("all"))
    between = F.split("text", F.col("_pattern"), -1)
    text = F.when(F.col("all").isNull(), F.col("text")).otherwise(F.array_join(
        F.zip_with(between, F.concat(F.col("all.new"), F.array(F.lit(""))), lambda a, b: F.concat(a, b)), ""))
    done = rows.join(by_row, row, "left").select(
        "doc_id", F.coalesce(F.size("all"), F.lit(0)).alias("n_entities"),
        F.coalesce(F.col("all.of"), F.array().cast("array<string>")).alias("kinds"), text.alias("text"))
    return clean.unionByName(done)
