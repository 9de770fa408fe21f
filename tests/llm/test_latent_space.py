"""The latent space of the decontamination is fit on every distinct block of the corpus."""

import random

import numpy as np
import pyarrow as pa

from glasswatch.llm import decontaminate
from glasswatch.llm.words import FOLDED, chunks, words_of


def _blocks_of(texts):
    out = []
    for c in chunks(pa.array(texts, pa.string())):
        w = words_of(c, FOLDED)
        f = decontaminate._features(w)
        start, _ = decontaminate._blocks(w)
        out += [tuple(f[a:b].tolist()) for a, b in zip(start, np.append(start[1:], len(f)), strict=True)]
    return out


def _texts():
    r = random.Random(3)
    # beyond 60,000 blocks of 16 short words
    made = [" ".join(f"w{r.randrange(4000):x}zz" for _ in range(r.randrange(1, 1500))) for _ in range(1800)]
    return [*made, *made[:300], "", "one two", None]


def test_every_distinct_block_is_fit(spark, monkeypatch):
    texts, seen = _texts(), {}

    def basis(fit, idf, rank):
        seen["rows"] = fit.count()
        return np.zeros((decontaminate.FEATURES, rank), np.float32)

    monkeypatch.setattr(decontaminate, "latent_basis", basis)
    decontaminate.latent_space(spark.createDataFrame([(x,) for x in texts], "text string").repartition(6))
    blocks = _blocks_of(texts)
    assert len(blocks) > 80_000 and seen["rows"] == len(set(blocks))


def test_basis_is_that_of_all_rows(spark):
    """Against the same iteration over the whole matrix of TF-IDF rows in numpy."""
    r = random.Random(5)
    texts = [" ".join(f"w{int(r.paretovariate(0.7)) % 500}" for _ in range(r.randrange(1, 90))) for _ in range(400)]
    rank = 12
    basis, idf = decontaminate.latent_space(spark.createDataFrame([(x,) for x in texts], "text string").repartition(5), rank)
    rows = sorted(set(_blocks_of(texts)))
    a = np.zeros((len(rows), decontaminate.FEATURES))
    for i, row in enumerate(rows):
        weight = idf[list(row)]
        np.add.at(a[i], list(row), weight / max(1e-6, np.sqrt((weight**2).sum())))
    x = np.random.default_rng(7).standard_normal((decontaminate.FEATURES, rank)) / np.sqrt(rank)
    for _ in range(2):
        q, s = np.linalg.qr(a.T @ (a @ x))
        u, values, _ = np.linalg.svd(s)
        x = q @ u
    expected = x / np.sqrt(np.maximum(values, values.max() * 1e-6 + 1e-12))
    assert np.allclose(basis @ basis.T, expected @ expected.T, atol=1e-3)


def test_a_feature_counts_once_a_block(spark):
    texts = [*_texts()[:60], "same same same " * 11, "a b a"]
    rows = decontaminate.passage_counts(spark.createDataFrame([(x,) for x in texts], "text string").repartition(3)).collect()
    blocks, got = _blocks_of(texts), {}
    for r in rows:
        if r["feature"] >= 0:
            got[r["feature"]] = got.get(r["feature"], 0) + r["n"]
    wanted = {decontaminate.FEATURES: len(blocks)}
    for f in (f for b in blocks for f in set(b)):
        wanted[f] = wanted.get(f, 0) + 1
    assert got == wanted
    assert sorted(np.frombuffer(r["passage"], "<u2").tolist() for r in rows if r["feature"] < 0) == sorted(map(list, blocks))


def test_only_words_that_may_be_rare_are_looked_up(monkeypatch):
    r = random.Random(11)
    items = [(i, " ".join(f"q{r.randrange(900)}" for _ in range(30)) + f". answer {i}.") for i in range(20)]
    idf = np.random.default_rng(1).random(decontaminate.FEATURES)
    it = decontaminate.Items(items, np.ones((decontaminate.FEATURES, 4), np.float32), idf)
    texts = [" ".join(f"w{r.randrange(9000):x}zz" for _ in range(800)) + " " + items[k % 20][1] for k in range(30)]
    w = words_of(next(chunks(pa.array(texts))), FOLDED)
    looked, real = [], np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda a, v, *more: (looked.append(np.size(v)), real(a, v, *more))[1])
    found = {(row, item) for row, item, _, _ in decontaminate.word_candidates(w, it)}
    assert found >= {(k, k % 20) for k in range(30)}
    assert sum(looked) < len(w.hash) / 10
