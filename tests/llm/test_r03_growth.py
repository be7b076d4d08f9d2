"""What the operators' cost grows with: pieces encoded again, vectors that can't be answers."""

import numpy as np
import pyarrow as pa

from mercato.llm import ann
from mercato.llm.tokenize import BatchEncoder, default_tokenizer


def test_half_a_million_pieces_are_encoded_once(monkeypatch):
    e = BatchEncoder(default_tokenizer())
    learnt, learn = [], e._learn
    monkeypatch.setattr(e, "_learn", lambda pieces: (learnt.append(len(pieces)), learn(pieces)))
    for begin in (0, 250_000, 0, 250_000):
        ids, offsets = e.encode(pa.array([" " + " ".join(f"{i:x}" for i in range(begin, begin + 250_000))]))
    assert sum(learnt) == 500_000
    own = " ".join(f"{i:x}" for i in range(499_000, 500_000))
    ids, offsets = e.encode(pa.array([" " + own, None, own]))
    want = [e.tk.encode(t, add_special_tokens=False).ids for t in (" " + own, "", own)]
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == want


def test_a_block_returns_nothing_below_what_is_found_already():
    x = np.random.default_rng(1).normal(size=(300, 8))
    flat = lambda v: pa.ListArray.from_arrays(np.arange(0, v.size + 1, 8), v.reshape(-1))
    held = pa.table({"id": np.arange(300), "d": np.full(300, 8), "least": np.arange(300), "embedding": flat(x)})
    score = x @ x[:3].T
    bar = [-np.inf, np.sort(score[:, 1])[-4], np.inf]
    asked = pa.table({"id": [0, 1, 2], "d": [8] * 3, "embedding": flat(x[:3]), "bar": bar})
    got = ann.block_search(21)(asked, held).to_pandas()
    assert got.groupby("id").size().to_dict() == {0: 21, 1: 4}
    assert (got[got.id == 1].hit.to_numpy() == np.argsort(-score[:, 1])[:4]).all()
