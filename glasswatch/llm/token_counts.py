"""Token counts under a SentencePiece BPE model, with a whole-token shortcut.

The model's pieces hold the space mark only as their first characters, never after another one, so no merge can span the
place where a space follows something else. A text is therefore the sum of its pre-tokens: runs of spaces with the
characters after them up to the next space, the dummy space in front of the text included. ``whole_tokens`` proves, by
encoding every piece of the vocabulary alone, which pre-tokens are a single token. Those are counted by look-up; the others are
merged by the library, each distinct one once per task while a bounded table has room.

The library writes a space as the mark U+2581 and knows no other mark, so a mark in a text counts as a space.

Counts equal those of encoding whole texts. Null and empty texts have no tokens. Texts are never cut. Repeated rows are counted
each, an empty table gives none, and extra columns are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glasswatch.llm.tables import ship

#: Pre-tokens of which a worker remembers the count at once; the table starts anew beyond that.
REMEMBERED = 1_000_000
PRE_TOKEN = re.compile(" +[^ ]*")
SPACE_MARK = "▁"


def check_model(model: sentencepiece.SentencePieceProcessor) -> None:
    """Raise if a piece has the space mark after another character: pre-tokens wouldn't be independent."""
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if SPACE_MARK in piece.lstrip(SPACE_MARK):
            raise ValueError(f"piece {piece!r} spans a space")
    for text in (" a", "a ", "a  b"):
        if model.decode(model.encode(text)) != text:
            raise ValueError("the model drops spaces")


def whole_tokens(model: sentencepiece.SentencePieceProcessor) -> dict[str, int]:
    """Pre-tokens without their first space that the model encodes alone as one token."""
    found = {}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if piece.startswith(SPACE_MARK) and not model.is_control(i):
            word = piece[1:].replace(SPACE_MARK, " ")
            if word and model.encode(word) == [i]:
                found[word] = 1
    return found


class Counter:
    """Counts tokens of whole texts; made once per worker."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        check_model(self.model)
        self.whole = whole_tokens(self.model)
        self.known = dict(self.whole)

    def count(self, text: str) -> int:
        if not text:
            return 0
        if SPACE_MARK in text:
            text = text.replace(SPACE_MARK, " ")
        if "  " in text or text[0] == " " or text[-1] == " ":
            words = [m[1:] for m in PRE_TOKEN.findall(" " + text)]
        else:
            words = text.split(" ")
        known = self.known
        try:
            return sum(map(known.__getitem__, words))
        except KeyError:
            self.learn({w for w in words if w not in known})
            return sum(self.of(w) for w in words)

    def of(self, word: str) -> int:
        n = self.known.get(word)
        return len(self.model.encode(word)) if n is None and word else 1 if n is None else n

    def learn(self, words: set[str]) -> None:
        if len(self.known) + len(words) > REMEMBERED:
            self.known = dict(self.whole)
        if len(words) <= REMEMBERED:
            rest = [w for w in words if w]
            self.known.update(zip(rest, map(len, self.model.encode(rest, num_threads=1)), strict=True))
            self.known[""] = 1  # a lone space mark


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """Per document: ``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens``, and ``over_limit``, more tokens than ``limit``."""
    ship(docs.sparkSession)

    def run(batches):
        c = counter(model_path)
        for b in batches:
            texts = b.column(1)
            counts = [c.count(t.as_py() or "") for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    counted = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    counted = counted.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
