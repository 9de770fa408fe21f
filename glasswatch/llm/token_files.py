"""Token ids of a corpus in a compressed file format: static range asymmetric numeral systems, blocks, checkpoints, checksums.

Writing: every text is encoded once and its ids, with the end id, are stored; their frequencies over all documents are summed and scaled to
one table that all blocks share; the documents are sorted by ``doc_id`` (nulls first, equal ids by content) and packed into blocks of
whole documents. A block is a row of a Parquet table: part and number, the documents' ids and lengths, the coded words, a
checkpoint for every STEPS steps, and the CRC-32 of its ids. LANES coder states take turns within a block, so a step
is one vector operation. Blocks are independent, and any checkpoint can be decoded from by itself.

Reading: blocks are decoded one by one in any task; the checksum of each must fit. The offset of a document in the corpus
comes from sums over parts, which count up their own blocks. Parquet is the container because Spark's commit protocol then covers lost tasks.

The pre-tokenizer folds case and never lets a token span white space or the edge of a run of letters (tried when an encoder is
made), so a text's ids are those of its words, and each distinct word is encoded once per worker while a bounded table has room; the table goes before ids are counted. Null and empty texts have the end id alone. Nothing is truncated.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict
from itertools import compress, count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glasswatch.llm.tables import give_back, ship, stored
from glasswatch.llm.words import chunks

BLOCK_IDS = 1 << 17
LANES, STEPS = 512, 128
SCALE = 20
LOW = np.uint64(1 << 31)
REMEMBERED = 150_000
#: Texts are split together, so that a word is looked up once for this many bytes.
SPLIT_BYTES = 2 << 20
#: Lower-case letters whose spelling in the byte alphabet is known, and signs that the pre-tokenizer cuts off behind a letter.
PLAIN = "^[a-zß-öø-ÿ]+$"
BEFORE_SIGN = "([A-Za-zÀ-ÖØ-öø-ÿ])([.,;:!?#*$%&])"
#: Marks that may join the letter before them only in one case, and the beginning of special tokens: such texts keep their case.
CASED = r"[\x{300}-\x{36F}]|<\|"
#: Words in one text for the model.
TOGETHER = 200
U = np.uint64


class Encoder:
    """Encodes whole texts word by word; made once per worker.

    Texts are lowered (A-Z), cut at ASCII white space and before signs behind a letter, and their words numbered by Arrow; each distinct
    word of a call is looked up once. What the normalizer and pre-tokenizer make of lower-case letters (PLAIN) is their spelling in
    the byte alphabet, so the model itself is given many of them at once; their ids are told apart by the suffix that ends a word. Any
    other word goes through the whole tokenizer by itself. Ids of words lie in one pool.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self.bare = Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        byte = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in range(256) if re.fullmatch(PLAIN, chr(c).lower())]
        # the signs that spell these are no lower-case letters themselves, so replacing one by one is safe
        self.spelling = {c: byte.pre_tokenize_str(c)[0][0] for c in letters if not c.isascii() and c == c.lower()}
        suffix = self.tokenizer.model.end_of_word_suffix
        self.ends = np.zeros(self.size, bool)
        if suffix:
            self.ends[[i for x, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if x.endswith(suffix)]] = True
        self.clear()
        samples = ["a b", "a b\nc", "é è", " a  b ", "Some words, then: more!? The end.", "ÉTÉ d'été%%% it's", " ".join(letters), "".join(letters)]
        samples += ["a\t b\r\nc\x0bd\x0ce\x1cf", "W\u030a w\u030a", "<|ENDOFTEXT|> <|endoftext|>", "IT'S,'s .'T x.'s", *(f"{a}{b}É{b} {b}{a}" for a in "aZ" for b in ".,;:!?#*$%&")]
        for text in samples:
            if list(self.ids([text])[0]) != self.tokenizer.encode(text, add_special_tokens=False).ids:
                raise ValueError("tokens of this tokenizer may span white space, or its words have no suffix")

    def clear(self) -> None:
        """Forget all words. They are numbered as they come; word 0 is empty."""
        self.known = defaultdict(count(1).__next__, {"": 0})
        self.pool, self.start, self.length = np.zeros(0, self.kind), np.zeros(1, np.int64), np.zeros(1, np.int64)

    @staticmethod
    def words(texts: pa.Array) -> pa.ListArray:
        """The words of each text, some of them empty."""
        cased = pc.match_substring_regex(texts, CASED)
        lower = pc.replace_substring_regex(pc.ascii_lower(texts), BEFORE_SIGN, r"\1 \2")
        return pc.ascii_split_whitespace(pc.if_else(cased, texts, lower) if pc.any(cased).as_py() else lower)

    def ids(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text ends in it."""
        if len(self.known) > REMEMBERED or len(self.pool) > 8 * REMEMBERED:
            self.clear()
        split = self.words(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()))
        each = pc.list_value_length(split).to_numpy()
        coded = split.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        at = np.fromiter(map(self.known.__getitem__, distinct), np.int32, len(distinct))
        if len(self.known) > len(self.start):
            self.learn(list(islice(reversed(self.known), len(self.known) - len(self.start)))[::-1])
        word = at[coded.indices.to_numpy()]
        n = self.length[word]
        upto = np.append(0, np.cumsum(n, dtype=np.int64))
        place = np.arange(upto[-1])
        place += np.repeat(self.start[word] - upto[:-1], n)
        return self.pool[place], upto[np.cumsum(each, dtype=np.int64)]

    def learn(self, new: list[str]) -> None:
        """Add newly numbered words to the pool."""
        is_plain = pc.match_substring_regex(pa.array(new, pa.large_string()), PLAIN).to_numpy(zero_copy_only=False)
        joined = self.spelled(list(compress(new, is_plain)))
        whole = self.tokenizer.encode_batch_fast(list(compress(new, ~is_plain)), add_special_tokens=False)
        whole = [np.array(e.ids, self.kind) for e in whole]
        length = np.zeros(len(new), np.int64)
        length[is_plain] = np.diff(np.flatnonzero(self.ends[joined]) + 1, prepend=0)
        length[~is_plain] = [len(x) for x in whole]
        start = np.zeros(len(new), np.int64)
        for part, at in ((is_plain, len(self.pool)), (~is_plain, len(self.pool) + len(joined))):
            start[part] = at + np.cumsum(length[part]) - length[part]
        self.pool = np.concatenate([self.pool, joined, *whole])
        self.start, self.length = np.append(self.start, start), np.append(self.length, length)

    def spelled(self, words: list[str]) -> np.ndarray:
        """The ids of lower-case words of letters in a row."""
        out = [np.zeros(0, self.kind)]
        for i in range(0, len(words), 50 * TOGETHER):
            groups = [" ".join(words[j : j + TOGETHER]) for j in range(i, min(i + 50 * TOGETHER, len(words)), TOGETHER)]
            for k, g in enumerate(groups):
                if not g.isascii():
                    for letter, spelling in self.spelling.items():
                        g = g.replace(letter, spelling)
                    groups[k] = g
            out += [np.array(e.ids, self.kind) for e in self.bare.encode_batch_fast(groups, add_special_tokens=False)]
        ids = np.concatenate(out)
        if np.count_nonzero(self.ends[ids]) != len(words):
            raise ValueError("words can't be told apart by their suffix")
        return ids


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def forget() -> None:
    """Give back what this worker keeps for encoding: later steps need the room for their own rows."""
    if _encoders:
        _encoders.clear()
        give_back()


def encoded(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """``doc_id`` and ``ids``: a document's token ids with ``end_id`` behind them, as little-endian integers."""

    def run(batches):
        if not _encoders:
            give_back()
        e = encoder(tokenizer_path)
        for b in batches:
            # cast before it is cut: Arrow's lower-casing misreads a part that was cast
            texts = pc.fill_null(b.column(1).cast(pa.large_string()), "")
            for c in chunks(texts, SPLIT_BYTES):
                ids, ends = e.ids(texts.slice(c.lo, c.hi - c.lo))
                ids = np.insert(ids, ends, end_id)
                offsets = np.append(0, ends + np.arange(1, len(ends) + 1)) * e.kind.itemsize
                blob = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(c.lo, c.hi - c.lo), blob.cast(pa.binary())], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary")


def frequencies(tokens: DataFrame, kind: np.dtype, size: int) -> np.ndarray:
    """How often each id occurs in all documents."""

    def run(batches):
        forget()
        sums = np.zeros(size, np.int64)
        for b in batches:
            offsets = np.frombuffer(b.column(0).buffers()[1], np.int32)[b.column(0).offset :][: len(b) + 1]
            if len(b):
                data = np.frombuffer(b.column(0).buffers()[2], kind, (offsets[-1] - offsets[0]) // kind.itemsize, offsets[0])
                sums += np.bincount(data, minlength=size)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(sums[used])], ["id", "n"])

    rows = tokens.select("ids").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.int64)
    out[rows.column("id").to_numpy()] = rows.column("n").to_numpy()
    return out


def scaled(counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Frequencies that add up to ``2**scale``, at least 1 for every id."""
    total = 1 << scale
    if len(counts) > total:
        raise ValueError("more ids than the scale has places")
    room = total - len(counts)
    share = counts.astype(np.float64) * (room / max(1, counts.sum()))
    freq = 1 + np.floor(share).astype(np.int64)
    rest = total - int(freq.sum())
    if counts.sum() == 0:
        freq[0] += rest
    else:
        order = np.lexsort((np.arange(len(counts)), -(share - np.floor(share))))
        freq[order[:rest]] += 1
    return freq


class Table:
    """Frequencies of all ids, where each begins, and which id a place belongs to."""

    def __init__(self, freq: np.ndarray, scale: int = SCALE):
        self.scale = U(scale)
        self.freq = freq.astype(U)
        self.begin = (np.cumsum(freq) - freq).astype(U)
        self.place = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)

    def encode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Coded words; states before every STEPS-th step (a row of LANES each); words read before these."""
        state = np.full(LANES, LOW, U)
        last = (len(ids) + LANES - 1) // LANES
        out, states, read, written = [], [], [], 0
        freq, begin = self.freq[ids], self.begin[ids]
        most, other = freq << (U(63) - self.scale), (U(1) << self.scale) - freq
        for s in range(last - 1, -1, -1):
            at = slice(s * LANES, (s + 1) * LANES)
            f = freq[at]
            x = state[: len(f)]
            over = np.flatnonzero(x >= most[at])
            if len(over):
                full = x[over]
                out.append(full.astype("<u4"))
                written += len(over)
                x[over] = full >> U(32)
            # (x // f << scale) + x % f + begin
            x += x // f * other[at]
            x += begin[at]
            if s % STEPS == 0:
                states.append(state.copy())
                read.append(written)
        words = np.concatenate(out[::-1]) if out else np.zeros(0, "<u4")
        return words, np.array(states[::-1], U).reshape(-1, LANES), written - np.array(read[::-1], np.int64)

    def decode(self, n: int, words: np.ndarray, states: np.ndarray, read: np.ndarray, first: int = 0, until: int | None = None) -> np.ndarray:
        """The ids of a block of ``n``, or only those from checkpoint ``first`` up to checkpoint ``until``."""
        lo, hi = first * STEPS, (n + LANES - 1) // LANES
        hi = hi if until is None else min(hi, until * STEPS)
        if hi <= lo:
            return np.zeros(0, np.uint32)
        out = np.empty(min(n, hi * LANES) - lo * LANES, np.uint32)
        state, at, mask = states[first].copy(), int(read[first]), U((1 << int(self.scale)) - 1)
        for s in range(lo, hi):
            x = state[: min(LANES, n - s * LANES)]
            place = x & mask
            ids = self.place[place]
            out[(s - lo) * LANES : (s - lo) * LANES + len(x)] = ids
            x = self.freq[ids] * (x >> self.scale) + place - self.begin[ids]
            need = np.flatnonzero(x < LOW)
            if len(need):
                x[need] = (x[need] << U(32)) | words[at : at + len(need)]
                at += len(need)
            state[: len(x)] = x
        return out


BLOCK_COLUMNS = "part int, block int, before long, doc_ids array<long>, lengths array<int>, n_ids long, words binary, states binary, read binary, crc32 long"


def write_blocks(tokens: DataFrame, table, kind: np.dtype, block_ids: int = BLOCK_IDS) -> DataFrame:
    """The stored block table of ``tokens(doc_id, ids)`` in ascending order of ``doc_id``."""

    def run(batches):
        forget()
        part, block, before = TaskContext.get().partitionId(), 0, 0
        t, docs, held, n = table.value, [], [], 0

        def flush():
            ids = np.concatenate(held).astype(np.uint32)
            words, states, read = t.encode(ids)
            row = [part, block, before, docs, [len(x) for x in held], len(ids), words.tobytes(), states.astype("<u8").tobytes(), read.astype("<i8").tobytes(), zlib.crc32(ids.astype("<u4").tobytes())]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, types, strict=True)], [c.split(" ")[0] for c in BLOCK_COLUMNS.split(", ")])

        for b in batches:
            for doc, x in zip(b.column(0), b.column(1), strict=True):
                docs.append(doc.as_py())
                held.append(np.frombuffer(x.as_py(), kind))
                n += len(held[-1])
                if n >= block_ids:
                    yield flush()
                    docs, held, n, block, before = [], [], 0, block + 1, before + n
        if held:
            yield flush()

    # ranges are sampled by a hash, so that no ids go to the driver; ids of one document id are sorted where they meet
    tie = F.xxhash64("ids")
    ordered = tokens.select("doc_id", "ids").repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "ids")
    return stored(ordered.mapInArrow(run, BLOCK_COLUMNS), "token-blocks")


def read_documents(blocks: DataFrame, table) -> DataFrame:
    """Per document of a block table: ``doc_id``, ``start``, ``n_tokens``, ``ids`` (unsigned 32-bit, little-endian).

    A block knows the ids before it in its part; where the parts start is joined while blocks are still coded.
    """

    def run(batches):
        forget()
        t = table.value
        for b in batches:
            for r in b.to_pylist():
                states = np.frombuffer(r["states"], "<u8").astype(U).reshape(-1, LANES)
                ids = t.decode(r["n_ids"], np.frombuffer(r["words"], "<u4").astype(U), states, np.frombuffer(r["read"], "<i8")).astype("<u4")
                if zlib.crc32(ids.tobytes()) != r["crc32"]:
                    raise ValueError(f"block {r['part']}/{r['block']} is damaged")
                lengths = np.array(r["lengths"], np.int64)
                ends = np.cumsum(lengths)
                own = [ids[e - k : e].tobytes() for e, k in zip(ends, lengths, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], pa.int64()), pa.array(ends - lengths + r["part_start"] + r["before"]), pa.array(lengths), pa.array(own, pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    placed = blocks.join(F.broadcast(part_starts(blocks)), "part")
    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def part_starts(blocks: DataFrame) -> DataFrame:
    """``part`` and ``part_start``, the ids of all parts before it: a row for each partition of the range exchange, so no more than its setting allows."""
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    return parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_start"))


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int = 2, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Write the ids of all documents and read them back: ``doc_id``, ``start``, ``n_tokens`` and ``ids`` per document."""
    spark = ship(docs.sparkSession)
    e = Encoder(tokenizer_path)
    tokens = stored(encoded(docs, tokenizer_path, end_id), "tokens")
    freq = scaled(frequencies(tokens, e.kind, max(e.size, end_id + 1)))
    table = spark.sparkContext.broadcast(Table(freq))
    blocks = write_blocks(tokens, table, e.kind, block_ids)
    return read_documents(blocks, table)
