"""Cross-tokenizer alignment with an identity-map fast path.

Every text, with a space before it, is encoded by a byte-level BPE (A) and by a piece model (B).
Byte offsets where tokens of both end cut them into groups; an A and a B token whose byte ranges
overlap are linked. A map from each A id to the B id of the same bytes is built once. Links that
follow it are counted in vectors of the vocabulary's length, one per task, so the bulk of the
corpus never becomes pairs; only the other links, those of irregular groups, enter the shuffle
of pairs (A id, B id). Both counts are numbers of documents.

Texts are encoded and aligned once, in numpy over the byte offsets of a slice of texts, and the
links of each document are stored by id pair in the shared folder; a second pass over that table
looks up the corpus-wide counts. Vectors have the size of a vocabulary; pair counts are broadcast
only up to `common.BROADCAST_ROWS` counted rows, else Spark joins them by shuffle.

A's ids are found by ranks where its file is a plain byte-level BPE whose merges are in the
order of their ids, which is several times faster and gives the same ids; otherwise its own
library encodes. The files are read on the driver and sent to the workers as bytes.

Defined results: a null or empty text, and one whose joined tokens of A or B are not the bytes of
space and text, has no tokens: zeros and an empty group text. Special tokens' strings are plain
text. Rows that repeat a document each get a row and count as documents of their own; a null
doc_id is like others. Very long texts are encoded whole, in a slice of their own. An empty table
gives an empty one. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from orderloom.llm.common import bounded_batches, row_slices, scratch, ship, small, table

ship(__name__)

A_FILE = "/opt/tokenizers/byte_bpe_50k.json"
B_FILE = "/opt/tokenizers/piece_bpe_32k.model"
# Fixed value: the expression by which this byte-level BPE cuts a text into words.
PATTERN = (
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def byte_letters() -> dict[str, int]:
    """The letters that a byte-level vocabulary writes for bytes: printable ones stand for
    themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain}
    others = [b for b in range(256) if b not in set(plain)]
    return letters | {chr(0x100 + i): b for i, b in enumerate(others)}


def byte_vocabulary(data: bytes) -> tuple[list[bytes], dict[bytes, int] | None]:
    """Bytes by id of a byte-level BPE file, and its ranks if ids alone give the merges."""
    held = json.loads(data)
    letters = byte_letters()
    vocab, added = held["model"]["vocab"], held.get("added_tokens", [])
    special = {t["id"]: t["content"].encode() for t in added}
    size = max([*vocab.values(), *special]) + 1
    out = [b""] * size
    for token, i in vocab.items():
        out[i] = special[i] if i in special else bytes(letters[c] for c in token)
    for i, token in special.items():
        out[i] = token
    merges = [m.split(" ") if isinstance(m, str) else m for m in held["model"]["merges"]]
    ids = [vocab["".join(m)] for m in merges]
    before = held.get("pre_tokenizer") or {}
    plain = (
        held.get("normalizer") is None
        and before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space")
        and all(t.get("special") for t in added)
        and len(ids) == len(vocab) - 256 - sum(t["content"] in vocab for t in added)
        and all(x < y for x, y in zip(ids, ids[1:]))
        and all(len(out[i]) > 1 for i in ids)
    )
    ranks = {b: i for i, b in enumerate(out) if i not in special}
    return out, ranks if plain else None


def piece_vocabulary(data: bytes) -> tuple[list[bytes], list[bool]]:
    """Bytes by id of a piece model, and which ids are single bytes."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=data)
    out, single = [], []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        single.append(sp.is_byte(i))
        out.append(
            bytes([int(piece[1:-1], 16)]) if single[-1] else piece.replace("▁", " ").encode()
        )
    return out, single


def identity_map(a: list[bytes], b: list[bytes], single: list[bool]) -> np.ndarray:
    """The B id of the same bytes for each A id, a piece before a byte; -1 if there is none."""
    by_bytes = {x: i for i, x in enumerate(b) if single[i]}
    by_bytes |= {x: i for i, x in enumerate(b) if not single[i]}
    return np.array([by_bytes.get(x, -1) if x else -1 for x in a], np.int64)


def tables(a_file: str = A_FILE, b_file: str = B_FILE) -> dict:
    """What workers need of the two files, as plain values."""
    with open(a_file, "rb") as file:
        a_data = file.read()
    with open(b_file, "rb") as file:
        b_data = file.read()
    a_bytes, ranks = byte_vocabulary(a_data)
    b_bytes, single = piece_vocabulary(b_data)
    return {
        "a_data": None if ranks else a_data,
        "ranks": ranks,
        "b_data": b_data,
        "a_bytes": a_bytes,
        "b_bytes": b_bytes,
        "identity": identity_map(a_bytes, b_bytes, single),
    }


def encoders(held: dict):
    """Functions from texts to lists of ids, of A (space included) and of B."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=held["b_data"])
    if held["ranks"]:
        import tiktoken

        bpe = tiktoken.Encoding(
            "ranks", pat_str=PATTERN, mergeable_ranks=held["ranks"], special_tokens={}
        )

        def a(texts: list[str]) -> list[list[int]]:
            return [bpe.encode_ordinary(" " + t) for t in texts]
    else:
        from tokenizers import Tokenizer

        bpe = Tokenizer.from_str(held["a_data"].decode())
        bpe.encode_special_tokens = True

        def a(texts: list[str]) -> list[list[int]]:
            return [bpe.encode(" " + t, add_special_tokens=False).ids for t in texts]

    return a, lambda texts: sp.encode(texts, num_threads=1)


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.array([x for one in lists for x in one], np.int64)


def align(a_ids: list, b_ids: list, a_len: np.ndarray, b_len: np.ndarray) -> dict[str, np.ndarray]:
    """Groups and links of texts whose tokens of A and B have the same bytes.

    Per link: its text, A id and B id; per token: its group. Every stretch of bytes between two
    neighbouring token ends belongs to one token of each side, which is one link.
    """
    a, b = _flat(a_ids), _flat(b_ids)
    a_end, b_end = np.cumsum(a_len[a]), np.cumsum(b_len[b])
    total = int(a_end[-1]) if len(a) else 0
    mark = np.zeros(total + 1, np.uint8)
    mark[a_end] = 1
    mark[b_end] |= 2
    ends = np.flatnonzero(mark)
    of_a, of_b = (mark[ends] & 1).astype(np.int64), (mark[ends] >> 1).astype(np.int64)
    n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (a_ids, b_ids))
    text_end = np.append(0, a_end)[np.cumsum(n_a)] if len(a_ids) else np.zeros(0, np.int64)
    cuts = ends[mark[ends] == 3]
    return {
        "a": a,
        "b": b,
        "n_a": n_a,
        "n_b": n_b,
        "text": np.searchsorted(text_end, ends, side="left"),
        "cut": mark[ends] == 3,
        "link_a": a[np.cumsum(of_a) - of_a],
        "link_b": b[np.cumsum(of_b) - of_b],
        "group_a": np.searchsorted(cuts, a_end, side="left"),
        "group_b": np.searchsorted(cuts, b_end, side="left"),
    }


def group_texts(found: dict[str, np.ndarray]) -> list[memoryview]:
    """The groups of each text as `a1,a2|b1;a3|b2,b3`, written for all texts at once."""
    a, b, ga, gb = (found[x] for x in ("a", "b", "group_a", "group_b"))
    at_a = np.arange(len(a)) + np.searchsorted(gb, ga, side="left")
    at_b = np.arange(len(b)) + np.searchsorted(ga, gb, side="right")
    value = np.zeros(len(a) + len(b), np.int64)
    mark = np.full(len(value), ord(","), np.uint8)
    value[at_a], value[at_b] = a, b
    for at, g, end in ((at_a, ga, "|"), (at_b, gb, ";")):
        last = np.ones(len(g), bool)
        last[:-1] = g[1:] != g[:-1]
        mark[at[last]] = ord(end)
    digits = np.ones(len(value), np.int64)
    power, widest = 10, 1
    while (value >= power).any():
        digits += value >= power
        power, widest = power * 10, widest + 1
    ends = np.cumsum(digits + 1)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    out[ends - 1] = mark
    for place in range(widest):
        some = digits > place
        out[ends[some] - 2 - place] = value[some] % 10 + ord("0")
        value //= 10
    borders = np.append(0, ends)[np.append(0, np.cumsum(found["n_a"] + found["n_b"]))]
    view = memoryview(out)
    return [view[x : max(x, y - 1)] for x, y in zip(borders, borders[1:])]


def pairs_by_text(text: np.ndarray, a: np.ndarray, b: np.ndarray, sizes: tuple[int, int]):
    """Distinct (text, a, b) in order, and how often each occurs."""
    n_a, n_b = sizes
    key, count = np.unique((text * n_a + a) * n_b + b, return_counts=True)
    rest, b = np.divmod(key, n_b)
    text, a = np.divmod(rest, n_a)
    return text, a, b, count


def _lists(of: np.ndarray, rows: int, values: np.ndarray) -> pa.Array:
    """Values, ordered by row, as one list per row."""
    offsets = np.append(0, np.cumsum(np.bincount(of, minlength=rows))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


_NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]
_LISTS = ["same_a", "same_n", "pair_a", "pair_b", "pair_n"]


def aligned(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    a_file: str = A_FILE,
    b_file: str = B_FILE,
    listed: bool = False,
) -> DataFrame:
    """Per document its counts, the digest of its groups (`listed`: their text too) and its links.

    `same_a`, `same_n`: A ids linked to the B id of their bytes, and how often. `pair_a`,
    `pair_b`, `pair_n`: the other links. `row` numbers the rows once the result is written.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(tables(a_file, b_file))
    schema = StructType(
        [StructField("row", LongType()), docs.schema[doc_id]]
        + [StructField(n, LongType()) for n in _NUMBERS]
        + [StructField("groups_sha256", StringType())]
        + ([StructField("groups", StringType())] if listed else [])
        + [StructField(n, ArrayType(IntegerType())) for n in _LISTS]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        a_bytes, b_bytes, identity = held["a_bytes"], held["b_bytes"], held["identity"]
        a_len, b_len = (np.array([len(x) for x in y], np.int64) for y in (a_bytes, b_bytes))
        encode_a, encode_b = encoders(held)
        sizes = (len(a_bytes), len(b_bytes))
        done = TaskContext.get().partitionId() << 36
        for batch in batches:
            for lo, hi in row_slices(batch.column(text)):
                part = batch.slice(lo, hi - lo)
                texts = [t or "" for t in part.column(text).to_pylist()]
                n = len(texts)
                a_ids, b_ids = encode_a(texts), encode_b(texts)
                for i, t in enumerate(texts):
                    whole = (" " + t).encode()
                    if (
                        not t
                        or b"".join([a_bytes[x] for x in a_ids[i]]) != whole
                        or b"".join([b_bytes[x] for x in b_ids[i]]) != whole
                    ):
                        a_ids[i] = b_ids[i] = []
                found = align(a_ids, b_ids, a_len, b_len)
                links = pairs_by_text(found["text"], found["link_a"], found["link_b"], sizes)
                of, a, b, count = links
                same = identity[a] == b
                written = group_texts(found)
                digests = [hashlib.sha256(x).hexdigest() if len(x) else "" for x in written]
                numbers = [
                    found["n_a"],
                    found["n_b"],
                    np.bincount(found["text"][found["cut"]], minlength=n),
                    np.bincount(found["text"], minlength=n),
                ]
                columns = [pa.array(np.arange(done, done + n)), part.column(doc_id)]
                columns += [pa.array(x.astype(np.int64)) for x in numbers]
                columns.append(pa.array(digests, pa.string()))
                if listed:
                    columns.append(pa.array([bytes(x).decode() for x in written], pa.string()))
                columns += [_lists(of[same], n, x[same]) for x in (a, count)]
                columns += [_lists(of[~same], n, x[~same]) for x in (a, b, count)]
                done += n
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(doc_id, text).mapInArrow(work, schema)


def identity_counts(stored: DataFrame, size: int) -> DataFrame:
    """(a, n): documents that link an A id to the B id of its bytes, by a vector per task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(np.asarray(batch.column("same_a").flatten()), minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(total[some])], names=["a", "n"]
        )

    parts = stored.select("same_a").mapInArrow(count, "a int, n long")
    return parts.groupBy("a").agg(F.sum("n").alias("n"))


def pair_counts(stored: DataFrame) -> DataFrame:
    """(a, b, n): documents that hold a pair of ids linked, other than identical ones."""
    pair = F.explode(F.arrays_zip("pair_a", "pair_b")).alias("p")
    return (
        stored.select(pair)
        .groupBy(F.col("p.pair_a").alias("a"), F.col("p.pair_b").alias("b"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def alignment(stored: DataFrame, held: dict) -> DataFrame:
    """(a, b, n, best, same): every linked pair and its number of documents.

    `best`: no other pair of that A id has more; `same`: the ids have the same bytes.
    """
    spark, identity = stored.sparkSession, held["identity"]
    known = [(int(a), int(identity[a])) for a in np.flatnonzero(identity >= 0)]
    names = spark.createDataFrame(known or [], "a int, b int")
    same = identity_counts(stored, len(identity)).join(names, "a")
    others = pair_counts(stored).withColumn("same", F.lit(False))
    every = others.unionByName(same.withColumn("same", F.lit(True)))
    every = scratch(every, "pairs")
    most = every.groupBy("a").agg(F.max("n").alias("most"))
    best = (F.col("n") == F.col("most")).alias("best")
    return every.join(most, "a").select("a", "b", "n", best, "same")


def scored(stored: DataFrame, counts: DataFrame, held: dict) -> DataFrame:
    """`stored` with n_best and count_sum, from a written table of `alignment`."""
    narrow = [c for c in stored.columns if c not in _LISTS]
    size = len(held["identity"])
    # identical pairs: one row per A id at most, a vector of the vocabulary's length
    numbered = counts.where("same").select("a", "n", "best").toArrow()
    count, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
    at = np.asarray(numbered.column("a"))
    count[at] = np.asarray(numbered.column("n"))
    best[at] = np.asarray(numbered.column("best").cast(pa.int8()))
    shared = stored.sparkSession.sparkContext.broadcast((count, best))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, best = shared.value
        for batch in batches:
            a = np.asarray(batch.column("same_a").flatten())
            n = np.asarray(batch.column("same_n").flatten()).astype(np.int64)
            offsets = np.asarray(batch.column("same_a").offsets).astype(np.int64)
            sums = []
            for weight in (best, count):
                running = np.append(0, np.cumsum(n * weight[a]))
                sums.append(pa.array(np.diff(running[offsets - offsets[0]])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in narrow] + sums, names=[*narrow, "_best", "_sum"]
            )

    fields = [stored.schema[c] for c in narrow]
    out = StructType(fields + [StructField(c, LongType()) for c in ("_best", "_sum")])
    plain = stored.select(*narrow, "same_a", "same_n").mapInArrow(add, out)
    pair = F.explode(F.arrays_zip("pair_a", "pair_b", "pair_n")).alias("p")
    links = stored.select("row", pair).select(
        "row", F.col("p.pair_a").alias("a"), F.col("p.pair_b").alias("b"), F.col("p.pair_n").alias("k")
    )
    looked = links.join(small(counts.where("NOT same")), ["a", "b"])
    others = looked.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("k")).otherwise(0)).alias("_more_best"),
        F.sum(F.col("k") * F.col("n")).alias("_more_sum"),
    )
    zero = F.lit(0).cast("long")
    return plain.join(others, "row", "left").select(
        *narrow,
        (F.col("_best") + F.coalesce("_more_best", zero)).alias("n_best"),
        (F.col("_sum") + F.coalesce("_more_sum", zero)).alias("count_sum"),
    )


def cross_tokens(docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """Each document with the numbers and digest of its alignment and its corpus-wide counts."""
    held = tables(a_file, b_file)
    stored = scratch(aligned(docs, a_file=a_file, b_file=b_file), "aligned")
    counts = scratch(alignment(stored, held), "alignment")
    return scored(stored, counts, held)


def op12_cross_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return cross_tokens(docs).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
