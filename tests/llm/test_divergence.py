"""The divergence of sources against a version over Python dictionaries."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from glasswatch.llm import divergence
from glasswatch.llm.divergence import Counts, Piece, condense
from glasswatch.llm.words import mix

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs, top):
    docs, groups = defaultdict(set), defaultdict(Counter)
    for i, (text, lang, source) in enumerate(rows):
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(LOWER))
        groups[lang, source].update(terms)
        for t in terms:
            docs[lang, t].add(i)
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for (x, t), d in docs.items() if x == lang and len(d) >= min_docs)
        sources = sorted(s for x, s in groups if x == lang)

        def p(counts, kept=kept):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}

        ps = {s: p(groups[lang, s]) for s in sources}
        q = p(sum((groups[lang, s] for s in sources), Counter()))
        f = lambda a, b: (a - b) * (a - b) // (a + b)
        for s in sources:
            pairs = [(o, sum(f(ps[s][t], ps[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, f(ps[s][t], q[t])) for t in kept if groups[lang, s][t] and ps[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(found[:most])]
    return sorted(out)


def made_rows():
    rng = np.random.default_rng(3)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)] + ["Über", "ÉCOLE", "naïve", "x　y", "a-B-a", "(the", "The", "the,", "\x7fdel"]
    rows = []
    for i in range(240):
        n = int(rng.integers(0, 60))
        picked = [words[int(j)] for j in rng.zipf(1.3, n) % len(words)]
        rows.append((rng.choice([" ", "\n", " \t"]).join(picked), ["en", "de", None][i % 3], f"s{rng.integers(0, 4)}" if i % 7 else None))
    rows += [(f"id-{i}, one{i}two", "en", "s1") for i in range(30)]  # a term that stands in a chunk of its own in each document
    rows += [(None, "en", "s0"), ("", "fr", "s0"), ("42 !!", "fr", "s9"), ("rare words only", "it", "s1"), ("rare words too", "it", "s2")]
    rows += [rows[5]] * 12 + [("long " + "tail " * 40_000, "en", "s2")]
    return rows


@pytest.mark.parametrize("min_docs", [1, 2, 10])
def test_against_brute_force(spark, min_docs):
    rows = made_rows()
    docs = spark.createDataFrame([(i, *r, "k", 1) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, term string, n long")
    got = sorted(tuple(r) for r in divergence.divergence(docs.repartition(7), min_docs=min_docs).collect())
    assert got == brute(rows, min_docs, 10)


def test_pairs_do_not_depend_on_blocks(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_CELLS", 16)  # read on the driver only
    rows = made_rows()[:150]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    assert sorted(tuple(r) for r in divergence.divergence(docs, min_docs=2, top=3).collect()) == brute(rows, 2, 3)


def test_empty_tables(spark):
    assert divergence.divergence(spark.createDataFrame([], "text string, lang string, source string")).collect() == []


def random_counts(rng, n):
    doc = rng.integers(-1, 30, n)
    return Counts(rng.integers(0, 2, n), np.where(doc < 0, rng.integers(0, 3, n), doc % 3), mix(rng.integers(0, 12, n).astype(np.uint64)), doc, rng.integers(1, 5, n))


def as_sets(c, row, n, doc):
    return sorted(zip(c.lang[row].tolist(), c.key[row].tolist(), c.source[row].tolist(), doc.tolist(), n.tolist(), strict=True))


def test_condensing_in_steps_changes_nothing():
    rng = np.random.default_rng(9)
    for _ in range(30):
        c = random_counts(rng, int(rng.integers(1, 400)))
        whole = as_sets(c, *condense(c, 5))
        parts = []
        for at in np.array_split(np.arange(len(c.key)), 3):
            piece = Counts(*(x[at] for x in c))
            row, n, doc = condense(piece, 5)
            parts.append(Counts(piece.lang[row], piece.source[row], piece.key[row], doc, n))
        again = Counts(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        assert as_sets(again, *condense(again, 5)) == whole


def test_pieces_survive_packing_and_compaction(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE_ROWS", 50)
    names = pa.array(["alpha", "beta", "gämma"])
    from glasswatch.llm.words import Chunk, words_of

    data, offsets = divergence._bytes_of(names)
    keys = words_of(Chunk(0, 3, data, offsets)).hash
    rng = np.random.default_rng(1)
    sent, read = Piece(4), Piece(4)
    sent.langs, sent.sources = {"en": 0, "": 1}, {"a": 0, "b\n": 1}
    want = Counter()
    for _ in range(20):
        name, lang, doc = rng.integers(0, 3, 30), rng.integers(0, 2, 30), rng.integers(5_000_000_000, 5_000_000_009, 30)
        n, source = rng.integers(1, 300, 30), doc % 2
        for i in range(30):
            want[names[int(name[i])].as_py(), int(lang[i]), int(source[i])] += int(n[i])
        sent.add(Counts(lang, source, keys[name], doc, n), names, name)
    assert sent.rows < 600
    for batch in sent.packed(6):
        for _, size, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            read.unpack(size, body)
    counts, found, name = read.condensed()
    langs, sources = list(read.langs), list(read.sources)
    got = Counter()
    for i in range(len(name)):
        got[found[int(name[i])].as_py(), {"en": 0, "": 1}[langs[counts.lang[i]]], {"a": 0, "b\n": 1}[sources[counts.source[i]]]] += int(counts.n[i])
    assert got == want
