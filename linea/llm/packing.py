"""Packing by concatenate and cut.

All documents are laid end to end and cut every ``window`` tokens. Pass one
tokenises and writes the ids to the shared checkpoint folder, which fixes
partitions and row order, and sums the tokens of each partition (one number a
partition reaches the driver). Their prefix sums are the partitions' global
offsets, so pass two cuts every partition on its own, without a shuffle: a
document's pieces get (sequence_id, offset) from its global offset, and the
sequence that runs over a partition's end is made of records of both sides.

Only the last sequence can be short. It is padded to ``window``, except when
its size is a power of two (``padded_to`` tells the size).

Edge cases: null or empty text is the closing id alone. Repeated rows are
packed one by one. Very long texts are tokenised whole and cut like any other.
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linea.llm.common import materialise

#: Characters for which lower-casing and splitting commute with the tokenizer's own steps.
PLAIN = "\t\n\r\x20-\x7e\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-įı-ɏ"
#: The tokenizer's own pieces of a word of plain characters, lower-cased.
PART = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
#: Words and parts of one generation of a worker's memory; it keeps two.
REMEMBER = 600_000
#: Rows of a batch that are Python objects at a time.
SLICE = 256
KINDS = {"id": pa.string(), "start": pa.int64(), "length": pa.int64(), "ids": pa.binary(), "doc_tokens": pa.int64(),
         "sequence_id": pa.int64(), "offset": pa.int64(), "sequence_tokens": pa.int64(), "padded_to": pa.int64()}
PIECES = ("id string, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, "
          "sequence_tokens bigint, padded_to bigint")


class Encoder:
    """Ids of whole texts, the same as the tokenizer's own, remembering the ids of words and their parts.

    The tokenizer lower-cases, drops white space and encodes each part of a
    word (letters, a digit, signs) by itself, closing it with an id that ends a
    word. So a plain text's ids are those of its words' parts, and many new
    parts are encoded in one call and told apart by their closing ids. Any
    other text (characters outside ``PLAIN``, or the marks of special tokens)
    goes to the tokenizer whole.

    Words and parts share one memory (a word of one part is that part) of two
    generations: when the younger one is full it becomes the older one, and what
    the older one held and is met again moves up. So frequent words stay.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        size = self.tokenizer.get_vocab_size()
        self.dtype = "<u2" if size <= 1 << 16 else "<u4"
        suffix = json.loads(spec)["model"].get("end_of_word_suffix") or ""
        self.closing = np.array([bool(suffix) and (self.tokenizer.id_to_token(i) or "").endswith(suffix) for i in range(size)])
        self.odd = re.compile(f"[^{PLAIN}]|<\\|") if self.closing.any() else re.compile("")
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def pack(self, ids: list[int]) -> bytes:
        return np.asarray(ids, dtype=self.dtype).tobytes()

    def unknown(self, strings: set[str]) -> list[str]:
        """Those of ``strings`` that no generation holds; the others are in the younger one afterwards."""
        missing = strings.difference(self.young)
        moved = {s: ids for s in missing if (ids := self.old.get(s)) is not None}
        self.young.update(moved)
        return list(missing.difference(moved)) if moved else list(missing)

    def learn_parts(self, parts: list[str]) -> None:
        ids = np.asarray(self.tokenizer.encode_batch_fast([" ".join(parts)], add_special_tokens=False)[0].ids, dtype=self.dtype)
        ends = (np.flatnonzero(self.closing[ids]) + 1).tolist()
        if len(ends) == len(parts) and ends[-1] == len(ids):
            raw, width = ids.tobytes(), ids.itemsize
            self.young.update(zip(parts, [raw[a * width:b * width] for a, b in zip([0, *ends], ends, strict=False)], strict=True))
        else:  # some part has other ids among others: one call each
            for p, e in zip(parts, self.tokenizer.encode_batch(parts, add_special_tokens=False), strict=True):
                self.young[p] = self.pack(e.ids)

    def learn_words(self, words: list[str]) -> None:
        split = [PART.findall(w) for w in words]
        new = self.unknown({p for s in split for p in s})
        for at in range(0, len(new), 5_000):
            self.learn_parts(new[at:at + 5_000])
        known = self.young
        known.update([(w, b"".join([known[p] for p in s])) for w, s in zip(words, split, strict=True) if len(s) > 1])

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [None if self.odd.search(t) else t.lower().split() for t in texts]
        whole = [t for t, s in zip(texts, split, strict=True) if s is None]
        direct = iter([self.pack(e.ids) for e in self.tokenizer.encode_batch(whole, add_special_tokens=False)] if whole else [])
        if len(self.young) > REMEMBER:
            self.young, self.old = {}, self.young
        known, out, later = self.young, [], []
        for i, s in enumerate(split):
            try:
                out.append(next(direct) if s is None else b"".join([known[w] for w in s]))
            except KeyError:  # a word not met lately
                out.append(b"")
                later.append(i)
        self.learn_words(self.unknown(set().union(*[split[i] for i in later])))
        for i in later:
            out[i] = b"".join([known[w] for w in split[i]])
        return out


_ENCODERS: dict[int, Encoder] = {}


def tokenise(docs: DataFrame, id_col: str, text: str, tokenizer: str, end_id: int) -> DataFrame:
    """(id as text, ids binary, n): little-endian token ids of each whole text, closed by ``end_id``.

    The tokenizer file is read on the driver and travels with the task's function.
    """
    with open(tokenizer, encoding="utf-8") as file:
        spec = file.read()
    encoders = _ENCODERS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(spec)
        if key not in encoders:
            encoders[key] = Encoder(spec)
        encoder = encoders[key]
        close = encoder.pack([end_id])
        width = len(close)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)  # only a slice's texts are Python objects at a time
                ids = [b + close for b in encoder.encode([t or "" for t in part.column(1).to_pylist()])]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()),
                                                  pa.array([len(b) // width for b in ids], pa.int64())], ["id", "ids", "n"])

    # ids travel as text: any type of id passes unchanged
    return (docs.select(F.col(id_col).cast("string").alias("id"), F.col(text).alias("text"))
            .mapInArrow(run, "id string, ids binary, n bigint"))


def pack(docs: DataFrame, id_col: str = "doc_id", text: str = "text", tokenizer: str = "", end_id: int = 1,
         window: int = 2048) -> DataFrame:
    """Pieces: (id, start, length, ids binary of little-endian 32-bit ids, doc_tokens,
    sequence_id, offset, sequence_tokens, padded_to)."""
    if not tokenizer:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    kind = dict(docs.dtypes)[id_col]
    rows = materialise(tokenise(docs, id_col, text, tokenizer, end_id)).withColumn("part", F.spark_partition_id())
    totals = dict(rows.groupBy("part").agg(F.sum("n")).collect())  # a number for each partition
    parts = sorted(totals)
    base = dict(zip(parts, accumulate([0, *(totals[p] for p in parts)]), strict=False))
    total = sum(totals.values())
    last, rest = divmod(total, window)
    padded = rest if rest & (rest - 1) == 0 else window

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        for batch in batches:
            for begin in range(0, batch.num_rows, SLICE):
                out: list[tuple] = []
                part = batch.slice(begin, SLICE)
                for where, key, ids, n in zip(*[c.to_pylist() for c in part.columns], strict=True):
                    if at is None:
                        at = base[where]
                    wide = np.frombuffer(ids, dtype="<u2" if len(ids) == 2 * n else "<u4").astype("<u4")
                    start = 0
                    while start < n:
                        sequence, offset = divmod(at + start, window)
                        length = min(window - offset, n - start)
                        end = sequence == last
                        out.append((key, start, length, wide[start:start + length].tobytes(), n, sequence, offset,
                                    rest if end else window, padded if end else window))
                        start += length
                    at += n
                columns = zip(*out, strict=True) if out else [[]] * len(KINDS)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, KINDS.values(), strict=True)], list(KINDS))

    pieces = rows.select("part", "id", "ids", "n").mapInArrow(cut, PIECES)
    return pieces.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids, padded_to): pieces joined in order; a sequence holds at most ``window`` tokens."""
    held = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (pieces.groupBy("sequence_id").agg(held.alias("p"), F.max("padded_to").alias("padded_to"))
            .select("sequence_id", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"), "padded_to"))
