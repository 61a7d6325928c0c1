"""Byte-level BPE with Spark higher-order functions over distinct words (operator 7).

A text is cut into words at places that the split pattern never crosses: white space, and the edges between runs of
letters, digits and other signs. All words are counted. The most frequent ones, down to a count that at most `entries`
words reach, are encoded once: a fold over a word's bytes that joins, step by step, the neighbours with the lowest rank,
looked up in a literal rank map. Their ids go to the tasks as one table of bounded size. Words outside the table, rare by
choice of that count, go through the same fold where they occur, so that neither texts nor words of documents are
shuffled and a growing vocabulary needs no larger table. The fold takes time with the square of a word, so words of over
LONG bytes are merged in passes by rank instead: each pass joins all neighbours of the lowest rank at once, and after it
only the neighbours of what was joined are looked up anew. Decoding looks up the bytes of each id and concatenates them.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barque.llm.rolling import Rolling
from barque.llm.storage import discard, stored

ENTRIES = 1_000_000
GROUP_BYTES = 1 << 18
LONG = 512  # bytes of a word that the fold still takes
#: Unicode white space, as the split pattern has it.
WS = r"\t-\r \x85\xa0  -     　"
PIECE = re.compile(f"[{WS}]+(?![^{WS}])| ?[^{WS}]+|[{WS}]+")
WIDE_SPACE = re.compile(b"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Letters 1, digits 2, other signs 3; 0 where no edge is looked for: white space, apostrophes and most of what isn't ASCII.
KIND = np.zeros(256, np.uint8)
KIND[33:127] = 3
KIND[48:58] = 2
KIND[[*range(65, 91), *range(97, 123)]] = 1
KIND[39] = 0


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


# ---- the fold --------------------------------------------------------------------------------------------------------


def rank_slots(ranks: dict[bytes, int]) -> tuple[list[int], list[int]]:
    """The rank map as two literal arrays: how far to shift a key's hash, by the hash's low 16 bits, and, by the low bits
    of the shifted hash, the hash with the rank in place of its low 16 bits. The hash is Spark's xxhash64 of the bytes."""
    size = 1 << max(4, (len(ranks) * 2 - 1).bit_length())
    rank_of = {xxhash.xxh64_intdigest(token, seed=42): rank for token, rank in ranks.items()}
    if len({h >> 16 for h in rank_of}) < len(ranks):
        raise ValueError("two keys of the rank map share a hash")
    sharing: dict[int, list[int]] = {}
    for h in rank_of:
        sharing.setdefault(h & 0xFFFF, []).append(h)
    slots, shifts = [0] * size, [0] * 0x10000
    for low, hashes in sorted(sharing.items(), key=lambda x: -len(x[1])):
        for shift in range(1, 48):
            at = [h >> shift & size - 1 for h in hashes]
            if len({*at}) == len(at) and not any(slots[i] for i in at):
                break
        else:
            raise ValueError("the rank map doesn't fit its slots")
        shifts[low] = shift
        for i, h in zip(at, hashes, strict=True):
            slots[i] = h & ~0xFFFF | rank_of[h]
    return shifts, [h - (1 << 64) if h >> 63 else h for h in slots]


def literal(values: list, kind: str) -> Column:
    return F.expr(f"from_json('{json.dumps(values)}', 'array<{kind}>')")


def let(value: Column, then) -> Column:
    return F.get(F.transform(F.array(value), then), F.lit(0))


NONE = 1 << 60  # above rank * 2**32 + place


def encoded(pieces: Column, ranks: dict[bytes, int], pattern: str) -> Column:
    """array<string> of pieces to array<array<long>> of their ids."""
    shifts, slots = rank_slots(ranks)
    mask = len(slots) - 1

    def all_pieces(table: Column) -> Column:
        def ranked(h: Column, i: Column | None = None) -> Column:
            """The rank of a hash, with a place below it if one is given; NONE without a rank."""
            shift = F.get(table["shifts"], h.bitwiseAND(0xFFFF).cast("int"))
            found = F.get(table["slots"], F.call_function("shiftrightunsigned", h, shift).bitwiseAND(mask).cast("int"))
            rank = found.bitwiseAND(0xFFFF)
            return F.when(F.shiftright(found.bitwiseXOR(h), 16) == 0, rank if i is None else F.shiftleft(rank, 32) + i).otherwise(F.lit(NONE))

        def word(w: Column) -> Column:
            def hashes(cuts: Column, n: int) -> Column:
                """Of every n neighbours."""
                return F.transform(F.slice(cuts, F.lit(1), F.size(cuts) - n), lambda c, i: F.xxhash64(F.substring(w, c, F.get(cuts, i + n) - c)))

            def merge(cuts: Column) -> Column:
                """Leave out the cut inside the leftmost neighbours of the lowest rank; without any, the word is done."""

                def joined(lowest: Column) -> Column:
                    at = lowest.bitwiseAND(0xFFFFFFFF).cast("int") + 1
                    rest = F.concat(F.slice(cuts, F.lit(1), at), F.slice(cuts, at + 2, F.size(cuts)))
                    merged = F.struct(rest.alias("cuts"), (F.size(cuts) < 4).alias("done"))
                    return F.when(lowest == NONE, F.struct(cuts.alias("cuts"), F.lit(True).alias("done"))).otherwise(merged)

                return let(F.array_min(F.transform(hashes(cuts, 2), ranked)), joined)

            n = F.length(w)
            start = F.struct(F.sequence(F.lit(1), n + 1).alias("cuts"), F.lit(False).alias("done"))
            ids = lambda s: F.transform(hashes(s["cuts"], 1), lambda h: ranked(h))
            fold = F.aggregate(F.sequence(F.lit(2), F.greatest(n, F.lit(2))), start, lambda s, _: F.when(s["done"], s).otherwise(merge(s["cuts"])), ids)
            return let(let(F.xxhash64(w), lambda h: ranked(h)), lambda rank: F.when(rank != NONE, F.array(rank)).otherwise(fold))

        java = F.lit("(?U)" + pattern)
        return F.transform(pieces, lambda p: F.flatten(F.transform(F.regexp_extract_all(p, java, F.lit(0)), lambda x: let(x.cast("binary"), word))))

    return let(F.struct(literal(shifts, "int").alias("shifts"), literal(slots, "bigint").alias("slots")), all_pieces)


def looked_up(ids: Column, values: list[str]) -> Column:
    """The binary that the hexadecimal values of the ids make up, one after the other."""
    return let(literal(values, "string"), lambda table: F.unhex(F.array_join(F.transform(ids, lambda i: F.get(table, i)), "")))


# ---- long words ------------------------------------------------------------------------------------------------------

NO_RANK = np.int64(1 << 40)


class Ranks:
    """Ranks by the hash of a token's bytes, for arrays of hashes."""

    def __init__(self, ranks: dict[bytes, int]):
        ends = np.cumsum([len(t) for t in ranks])
        starts = np.concatenate(([0], ends[:-1]))
        hashes = Rolling(b"".join(ranks)).spans(starts, ends)
        order = np.argsort(hashes)
        self.keys, self.values = hashes[order], np.array(list(ranks.values()), np.int64)[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two keys of the rank map share a hash")

    def of(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, hashes)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == hashes, self.values[at], NO_RANK)


def merged(word: bytes, ranks: Ranks) -> np.ndarray:
    """The ids of one word by passes over all neighbours of the lowest rank.

    That is the order of single merges, the lowest rank first and of equal ones the leftmost, as long as no new pair ranks
    below the pass; where one would, the pass joins only its leftmost pair.
    """
    roll, n = Rolling(word), len(word)
    whole = ranks.of(roll.spans(np.array([0]), np.array([n])))
    if whole[0] < NO_RANK:
        return whole
    cuts = np.arange(n + 1)
    pairs = ranks.of(roll.spans(cuts[:-2], cuts[2:]))
    while len(pairs) and (lowest := pairs.min()) < NO_RANK:
        at = np.flatnonzero(pairs == lowest)
        in_run = np.arange(len(at)) - np.maximum.accumulate(np.where(np.concatenate(([True], np.diff(at) > 1)), np.arange(len(at)), 0))
        at = at[in_run % 2 == 0]  # of overlapping pairs every other one, from the left
        after = ranks.of(roll.spans(cuts[at[at + 3 < len(cuts)]], cuts[at[at + 3 < len(cuts)] + 3]))  # joined, and the next one not yet
        for joined in (at, at[:1]) if after.min(initial=NO_RANK) > lowest else (at[:1],):
            left = np.delete(cuts, joined + 1)
            now = np.delete(pairs, joined)  # the pair itself goes; its neighbours are other pairs now
            place = joined - np.arange(len(joined))  # of the joined token among the tokens that are left
            near = np.unique(np.concatenate((place - 1, place)))
            near = near[(near >= 0) & (near < len(now))]
            now[near] = ranks.of(roll.spans(left[near], left[near + 2]))
            if not len(near) or now[near].min() > lowest:
                break
        cuts, pairs = left, now
    return ranks.of(roll.spans(cuts[:-1], cuts[1:]))


# ---- pieces in tasks -------------------------------------------------------------------------------------------------


def piece_starts(data: np.ndarray, firsts: np.ndarray, raw: bytes) -> np.ndarray:
    """Starts of the pieces of concatenated texts; firsts: where each non-empty text starts."""
    space = SPACE[data]
    n = len(data)
    begin, end = np.zeros(n, bool), np.zeros(n, bool)
    begin[firsts] = True
    end[firsts[1:] - 1] = True
    if n:
        end[-1] = True
    after_space = np.empty(n, bool)  # the byte before is white space of the same text
    after_space[1:] = space[:-1]
    after_space[begin] = False
    after_plain = np.empty(n, bool)  # ... that isn't the plain space
    after_plain[1:] = data[:-1] != 0x20
    before_word = np.empty(n, bool)
    before_word[:-1] = ~space[1:]
    before_word[end] = False
    starts = begin | (~space & after_space & after_plain) | (space & before_word) | (space & ~after_space)
    kind = KIND[data]
    latin = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7))  # two-byte letters
    kind[latin] = kind[latin + 1] = 1
    starts[1:] |= (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
    if WIDE_SPACE.search(raw):  # those texts by the pattern itself
        ends = np.append(firsts[1:], n)
        for s, e in zip(firsts.tolist(), ends.tolist(), strict=True):
            part = raw[s:e]
            if WIDE_SPACE.search(part):
                starts[s:e] = False  # edges of runs in them are left to the pattern
                at = s
                for m in PIECE.findall(part.decode()):
                    starts[at] = True
                    at += len(m.encode())
    return np.flatnonzero(starts)


def groups(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[bytes]]]:
    """Rows [i, j) of bounded bytes (one row at least)."""
    i, held, texts = 0, 0, []
    for j, x in enumerate(batch.column("data")):
        x = x.as_py()
        if texts and held + len(x) > GROUP_BYTES:
            yield i, j, texts
            i, held, texts = j, 0, []
        texts.append(x)
        held += len(x)
    if texts:
        yield i, i + len(texts), texts


def hashed_pieces(texts: list[bytes]):
    raw = b"".join(texts)
    sizes = np.array([len(x) for x in texts])
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    data = np.frombuffer(raw, np.uint8)
    starts = piece_starts(data, bounds[:-1][sizes > 0], raw)
    ends = np.append(starts[1:], len(data))[: len(starts)]
    return raw, bounds, starts, ends, Rolling(data).spans(starts, ends) if len(starts) else np.empty(0, np.uint64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words of a batch with their counts."""
    for batch in batches:
        hashes, counts, words = [], [], []
        for _, _, texts in groups(batch):
            raw, _, starts, ends, h = hashed_pieces(texts)
            short = ends - starts <= LONG
            starts, ends, h = starts[short], ends[short], h[short]
            keys, first, n = np.unique(h, return_index=True, return_counts=True)
            hashes.append(keys)
            counts.append(n)
            words.append(np.array([raw[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist(), strict=True)], object))
        if hashes:
            keys, first, back = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
            n = np.bincount(back, np.concatenate(counts), len(keys)).astype(np.int64)
            found = pa.array(np.concatenate(words)[first], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), found, pa.array(n)], ["h", "piece", "n"])


class Table:
    """Sorted piece hashes with their ids."""

    def __init__(self, hashes: np.ndarray, sizes: np.ndarray, ids: np.ndarray):
        order = np.argsort(hashes)
        at = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        self.keys, self.at, self.sizes, self.ids = hashes[order], at[order].astype(np.int64), sizes[order].astype(np.int64), ids

    def find(self, h: np.ndarray) -> np.ndarray:
        """Place of each hash, or -1."""
        if not len(self.keys):
            return np.full(len(h), -1)
        keys, back = np.unique(h, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        at[self.keys[at] != keys] = -1
        return at[back]


def gather(flat: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """flat[at : at + size] for all, one after the other."""
    total = int(sizes.sum())
    if not total:
        return flat[:0]
    step = np.repeat(at - (np.cumsum(sizes) - sizes), sizes)
    return flat[step + np.arange(total)]


def _lookup(table, ranks, pattern: str):
    """Each text as its known ids, in one part more than it has rare words, and those words. Long words are merged here."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t: Table = table.value
        words_of = regex.compile(pattern).findall
        for batch in batches:
            for i, j, texts in groups(batch):
                raw, bounds, starts, ends, h = hashed_pieces(texts)
                found = t.find(h)
                long = np.flatnonzero(ends - starts > LONG)
                known = found >= 0
                known[long] = True
                short = known.copy()
                short[long] = False
                sizes = np.zeros(len(h), np.int64)
                sizes[short] = t.sizes[found[short]]
                of_long = [np.concatenate([merged(w.encode(), ranks.value) for w in words_of(raw[starts[x] : ends[x]].decode())]) for x in long.tolist()]
                sizes[long] = [len(x) for x in of_long]
                before = np.concatenate(([0], np.cumsum(sizes)))
                ids = np.empty(before[-1], np.int32)
                if short.any():
                    ids[np.repeat(short, sizes)] = gather(t.ids, t.at[found[short]], sizes[short])
                for x, own in zip(long.tolist(), of_long, strict=True):
                    ids[before[x] : before[x + 1]] = own
                first = np.searchsorted(starts, bounds)  # words of each text
                first[-1] = len(starts)
                rare = np.flatnonzero(~known)
                of_text = np.searchsorted(rare, first)
                edges = np.empty(j - i + len(rare) + 1, np.int32)
                outer = (np.arange(j - i + 1) + of_text).astype(np.int32)
                edges[outer] = before[first]
                edges[np.arange(len(rare)) + np.repeat(np.arange(j - i), np.diff(of_text)) + 1] = before[rare]
                parts = pa.ListArray.from_arrays(pa.array(outer), pa.ListArray.from_arrays(pa.array(edges), pa.array(ids)))
                words = pa.array([raw[s:e] for s, e in zip(starts[rare].tolist(), ends[rare].tolist(), strict=True)], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), parts, pa.ListArray.from_arrays(pa.array(of_text.astype(np.int32)), words)], ["doc_id", "parts", "rare"])

    return task


def frequent(counts: DataFrame, entries: int) -> DataFrame:
    """The words whose count no more than `entries` words reach. counts: one row per word, with n."""
    reached = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).withColumn("upto", F.sum("words").over(Window.orderBy(F.desc("n"))))  # a row for each count that occurs
    least = reached.filter(F.col("upto") <= entries).agg(F.min("n")).first()[0]
    return counts.filter(F.lit(False) if least is None else F.col("n") >= least)


def encode_decode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, entries: int = ENTRIES, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Encode each whole text, each match of `pattern` separately, and decode the ids again.

    Returns doc_id, n_tokens, ids_sha256, decoded_sha256 and, with_ids, ids (array) and decoded (binary). A null or empty
    text has no ids; repeated rows give repeated rows; a null id stays null; an empty table gives no rows; other columns
    are ignored. Ranks must hold every single byte and stay under 65,536; the pattern must never match across white space
    or an edge between letters, digits and other signs but at an apostrophe.
    """
    if max(ranks.values(), default=0) >= 1 << 16 or any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("ranks must be below 65,536 and hold every byte")
    sc = docs.sparkSession.sparkContext
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("data"))
    counts = stored(rows.select("data").mapInArrow(_count, "h long, piece string, n long").groupBy("h", "piece").agg(F.sum("n").alias("n")), "words")
    once = frequent(counts, entries).repartition(max(64, sc.defaultParallelism * 4)).select("h", F.get(encoded(F.array("piece"), ranks, pattern), F.lit(0)).cast("array<int>").alias("ids"))
    got = once.toArrow()
    discard(counts)
    ids = got.column("ids").combine_chunks()
    sizes = ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int32) if len(ids) else np.empty(0, np.int32)
    flat = ids.flatten().to_numpy(zero_copy_only=False).astype(np.uint16) if len(ids) else np.empty(0, np.uint16)
    table = sc.broadcast(Table(got.column("h").to_numpy().view(np.uint64), sizes, flat))
    hexes, wide = [""] * (max(ranks.values()) + 1), [i.to_bytes(4, "little").hex() for i in range(max(ranks.values()) + 1)]
    for token, rank in ranks.items():
        hexes[rank] = token.hex()
    found = rows.mapInArrow(_lookup(table, sc.broadcast(Ranks(ranks)), pattern), "doc_id long, parts array<array<int>>, rare array<string>")
    of_rare = encoded(F.col("rare"), ranks, pattern).cast("array<array<int>>")
    found = found.withColumn("rare", F.when(F.size("rare") > 0, of_rare).otherwise(F.array().cast("array<array<int>>")))
    both = F.flatten(F.transform("parts", lambda x, i: F.concat(x, F.coalesce(F.get("rare", i), F.array().cast("array<int>")))))
    found = found.select("doc_id", F.when(F.size("rare") > 0, both).otherwise(F.flatten("parts")).alias("ids"))
    out = found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(looked_up(F.col("ids"), wide), 256).alias("ids_sha256"), "ids", looked_up(F.col("ids"), hexes).alias("decoded"))
    return out.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"), *(["ids", "decoded"] if with_ids else []))


def op7_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return encode_decode(spark.read.parquet(f"{sf_dir}/documents.parquet"), ranks, public_tokenizers.PATTERN, with_ids=False)
