"""Concatenate and cut: documents as token ids in fixed windows, by two-pass prefix sums (operator 4).

Pass 1 tokenizes each document once, in the partition where it was read, and writes its ids with the number of ids that
the partition holds before it. Between the passes only one total per partition is summed up; its running sum gives each
partition's place in the whole stream. Pass 2 is Spark SQL over the written ids: offset, cut, checksum. No ids are
shuffled or sorted.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barque.llm.storage import stored

LENGTH, EOS = 4096, 2
CACHE_ENTRIES = 600_000
BATCH_BYTES = 8 << 20
#: The split pattern in the vocabulary file's pre-tokenizer.
PIECE = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""
#: Python's white space beyond Unicode's.
_EXTRA_SPACE = re.compile("[\x1c-\x1f]")
#: Letters whose composition, case and class every Unicode version agrees on.
_PLAIN = re.compile("[\x00-ɏ]*")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 256
    for b in range(256):
        out.append(chr(b if b in plain else extra))
        extra += b not in plain
    return out


class Words(dict):
    """Ids of a white-space-separated piece of text, as little-endian unsigned 32-bit bytes; a cache of bounded size.

    The vocabulary's normalizer and pre-tokenizer never look past white space, so a text's ids are those of its pieces
    in turn; only a text with an added token goes through the tokenizer whole, as those are matched before both.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [*self.tokenizer.get_added_tokens_decoder().values()]
        # tokens that are matched in normalized text can't be looked for here: then every text goes through whole
        names = [""] if any(t.normalized for t in added) else [t.content for t in added]
        self.added = re.compile("|".join(map(re.escape, names)) if names else "(?!)").search
        self.mark = os.path.commonprefix(names)  # quicker to look for than the tokens
        self.model = self.tokenizer.model
        self.split = regex.compile(PIECE).findall
        self.letters = byte_letters()
        self.parts: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        ids = self[piece] = self.ids(piece)
        return ids

    def ids(self, piece: str) -> bytes:
        if not _PLAIN.fullmatch(piece):
            return self.whole(piece)
        low = piece.lower() if piece.isascii() else unicodedata.normalize("NFC", piece).lower()
        if low.isalpha():
            return self.part(low)
        if low[-1] in ".," and low[:-1].isalpha():
            return self.part(low[:-1]) + self.part(low[-1])
        return b"".join(map(self.part, self.split(low)))

    def part(self, word: str) -> bytes:
        ids = self.parts.get(word)
        if ids is None:
            if len(self.parts) >= CACHE_ENTRIES:
                self.parts.clear()
            text = word if word.isascii() and word.isalnum() else "".join(self.letters[b] for b in word.encode())
            ids = self.parts[word] = b"".join(t.id.to_bytes(4, "little") for t in self.model.tokenize(text))
        return ids

    def whole(self, text: str) -> bytes:
        return b"".join(i.to_bytes(4, "little") for i in self.tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, text: str) -> bytes:
        if _EXTRA_SPACE.search(text) or self.mark in text and self.added(text):
            return self.whole(text)
        return b"".join(map(self.__getitem__, text.split()))


_WORDS: dict[str, Words] = {}


def _tokenize(path: str, eos: int):
    tail = eos.to_bytes(4, "little")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _WORDS.get(path) or _WORDS.setdefault(path, Words(path))
        part, before, held = TaskContext.get().partitionId(), 0, 0
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["doc_id", "part", "before", "n", "ids"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = words.encode(text.as_py()) + tail
                rows.append((doc_id, part, before, len(ids) // 4, ids))
                before += len(ids) // 4
                held += len(ids)
                if held >= BATCH_BYTES:
                    yield flush()
                    rows.clear()
                    held = 0
        if rows:
            yield flush()

    return task


def pack(docs: DataFrame, vocabulary: str, length: int = LENGTH, eos: int = EOS, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Pack every document, followed by `eos`, into sequences of `length` tokens; only the last may be shorter.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, with_ids, ids (binary, 4
    bytes each). Documents follow one another in the order in which they are read; repeated rows are packed as often as
    they occur. A null or empty text is its `eos` alone; a null id stays null; an empty table gives no rows; other
    columns are ignored.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ids = stored(texts.mapInArrow(_tokenize(vocabulary, eos), "doc_id long, part int, before long, n long, ids binary"), "ids")
    totals = ids.groupBy("part").agg(F.sum("n").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition of the input
    bases = stored(totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base")), "bases")
    placed = ids.join(bases, "part").withColumn("first", F.expr("base + before"))
    piece = f"""transform(sequence(first div {length}, (first + n - 1) div {length}), s -> struct(
        greatest(first, s * {length}) - first as start,
        least(first + n, (s + 1) * {length}) - greatest(first, s * {length}) as length, s as sequence_id))"""
    cut = f"substring(ids, cast(p.start * 4 + 1 as int), cast(p.length * 4 as int))"
    full = f"transform({piece}, p -> struct(p.start, p.length, p.sequence_id, crc32({cut}) as ids_crc32" + (f", {cut} as ids" if with_ids else "") + "))"
    out = placed.select("doc_id", F.col("n").alias("doc_tokens"), "first", F.explode(F.expr(full)).alias("p"))
    columns = ["doc_id", "p.start", "p.length", "p.ids_crc32", "doc_tokens", "p.sequence_id", F.expr(f"first + p.start - p.sequence_id * {length}").alias("offset")]
    return out.select(*columns, *["p.ids"] * with_ids)


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_pack(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary(), with_ids=False)
