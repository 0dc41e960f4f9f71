"""SentencePiece encoding and decoding with a max-plus parallel scan for giant documents.

Encoding finds the segmentation into vocabulary pieces with the largest sum of piece scores
(max-plus shortest path); characters outside the vocabulary become byte pieces, so decoding
restores every text exactly. Scores are whole numbers here, so sums are exact and ties are the
same however a text is cut: of equal sums, the longest last piece is taken.

A text of at most `chunk` characters is one chunk. A longer one is split into chunks at fixed
places, in the middle of words too, and each chunk is worked on by itself:

1. Its transfer matrix holds the best score from each of the last nodes before the chunk to each
   of the last nodes of the chunk (as many as a piece can be long). Where no piece can span some
   place in the chunk, all paths meet there and the matrix is a sum of a column and a row.
2. Matrices are combined associatively, in blocks and then over the blocks of a document; the
   prefix products give every chunk the scores at its start.
3. With these each chunk maps each end node to the node where the path enters it; these maps are
   combined associatively from the end, which gives every chunk its end node.
4. Each chunk traces its own pieces back from its end node.

Piece files are read on the driver (`model_file`), and the vocabulary, which has a fixed size, is
sent to the tasks. A text is one row, so the tokens of a document are one row as well.

Defined results: a null text has null tokens, an empty text none. Repeated rows each get the same
tokens; equal giant texts are encoded once. Null ids and other columns are kept as they are; an
empty table gives an empty one. A literal U+2581 and every character outside the vocabulary is
encoded as its bytes.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from orderloom.llm.common import bounded_batches, scratch, share, shared_value, ship, table

ship(__name__)

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 65_536
BLOCK = 256  # chunks whose matrices are combined in one task
CACHE = 300_000
# Parts of one that a fractional piece score is kept to.
SCALE = 1 << 20
SPACE, LITERAL = "▁", "\udc00"  # the second stands for a literal U+2581 in a text
NONE = np.int64(-(1 << 60))


class Vocabulary:
    """Pieces with whole-number scores, byte pieces, and the places no piece can span."""

    def __init__(self, pieces: list[tuple[str, int, int]], byte_ids: list[int], unknown: int):
        self.ids = {p: i for p, i, _ in pieces}
        self.score = {p: s for p, _, s in pieces}
        self.byte_ids, self.unknown = byte_ids, unknown
        self.longest = max(map(len, self.ids))
        # every prefix of a piece; the score where the prefix is a piece itself
        self.starts: dict[str, int | None] = {p[:n]: None for p in self.ids for n in range(1, len(p))}
        self.starts |= self.score
        self.bytes = {i: p.replace(SPACE, " ").encode() for p, i, _ in pieces}
        self.bytes |= {i: bytes([b]) for b, i in enumerate(byte_ids)}
        # a piece holds the space mark at its start only: none spans the place before a mark
        marked = all(SPACE not in p.lstrip(SPACE) for p in self.ids)
        # marks that occur in no longer piece stand alone
        inside = {c for p in self.ids if len(p) > 1 for c in p}
        alone = "".join(c for c in "\n\t\r" if c not in inside)
        lone = f"[{re.escape(alone)}]|" if alone else ""
        rest = re.escape(alone)
        self.segments = (
            re.compile(f"{lone}{SPACE}+[^{SPACE}{rest}]*|[^{SPACE}{rest}]+")
            if marked
            else re.compile(r"(?s).+")
        )

        self.held: Segments | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"held": None}

    @classmethod
    def load(cls, model_file: str) -> Vocabulary:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces, byte_ids, lowest = [], [0] * 256, 0
        scores = [sp.get_score(i) for i in range(sp.get_piece_size())]
        # log-probabilities differ by fractions: whole numbers of 2^-20; ranks are whole already
        scale = 1 if all(x == round(x) for x in scores) else SCALE
        for i in range(sp.get_piece_size()):
            if sp.is_byte(i):
                byte_ids[int(sp.id_to_piece(i)[1:-1], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                score = round(scores[i] * scale)
                pieces.append((sp.id_to_piece(i), i, score))
                lowest = min(lowest, score)
        return cls(pieces, byte_ids, lowest - 10 * scale)

    def fallback(self, c: str) -> list[int]:
        return [self.byte_ids[b] for b in (SPACE if c == LITERAL else c).encode()]


def marked(text: str) -> str:
    """The text as it is segmented: a leading space, and space marks for spaces."""
    return SPACE + text.replace(SPACE, LITERAL).replace(" ", SPACE)


class Segments(dict):
    """Tokens by segment. Two generations: what is not asked for again goes."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__()
        self.v, self.older = vocabulary, {}

    def __missing__(self, text: str) -> tuple[int, ...]:
        tokens = self.older.get(text)
        if tokens is None:
            tokens = self._best(text)
        if len(text) <= 64:
            if len(self) >= CACHE:
                self.older = dict(self)
                self.clear()
            self[text] = tokens
        return tokens

    def _best(self, text: str) -> tuple[int, ...]:
        get, unknown, end = self.v.starts.get, self.v.unknown, len(text)
        best, back = [0] + [int(NONE)] * end, [0] * (end + 1)
        for i in range(end):
            here, j = best[i], i + 1
            s = get(text[i:j])
            if s is None:
                s = unknown
            while s is not False:
                # nodes are left in order, so the longest of equal last pieces came first
                if s is not None and here + s > best[j]:
                    best[j], back[j] = here + s, i
                j += 1
                if j > end:
                    break
                s = get(text[i:j], False)
        parts, node = [], end
        while node:
            piece = text[back[node] : node]
            token = self.v.ids.get(piece)
            parts.append((token,) if token is not None else self.v.fallback(piece))
            node = back[node]
        return tuple(itertools.chain.from_iterable(reversed(parts)))


class Coder:
    """Best paths over the nodes between characters, with a bounded cache of segments."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        # kept with the broadcast vocabulary, so that the next task of a worker finds it filled
        if vocabulary.held is None:
            vocabulary.held = Segments(vocabulary)
        self.segments = vocabulary.held

    def forward(self, text: str, best: np.ndarray | list, first: int) -> tuple[list, list]:
        """Best scores and last steps of nodes from `first` on; those before are given."""
        starts, unknown, end, none = self.v.starts, self.v.unknown, len(text), int(NONE)
        best = [*best, *[none] * (end + 1 - len(best))]
        back = [0] * (end + 1)
        for i in range(max(0, first - self.v.longest), end):
            here = best[i]
            if here <= none:
                continue
            j = i + 1
            s = starts.get(text[i:j])
            if s is None:
                s = unknown
            while True:
                # nodes are left in order, so the longest of equal last pieces came first
                if s is not None and j >= first and here + s > best[j]:
                    best[j], back[j] = here + s, j - i
                j += 1
                if j > end:
                    break
                s = starts.get(text[i:j], False)
                if s is False:
                    break
        return best, back

    def pieces(self, text: str, i: int, j: int) -> list[int]:
        piece = text[i:j]
        return [self.v.ids[piece]] if piece in self.v.ids else self.v.fallback(piece)

    def trace(self, text: str, back: list, node: int, stop: int) -> tuple[list[int], int]:
        """Pieces from `node` back to the first node at or before `stop`, and that node."""
        steps = []
        while node > stop:
            steps.append(self.pieces(text, node - back[node], node))
            node -= back[node]
        return list(itertools.chain.from_iterable(reversed(steps))), node

    def score(self, text: str) -> int:
        return self.forward(text, [0], 1)[0][-1]

    def encode(self, text: str) -> np.ndarray:
        """Tokens of a text of one chunk."""
        if not text:
            return np.zeros(0, np.int32)
        words = self.v.segments.findall(marked(text))
        return np.fromiter(
            itertools.chain.from_iterable(map(self.segments.__getitem__, words)), np.int32
        )

    def decode(self, tokens) -> str:
        return b"".join(map(self.v.bytes.__getitem__, tokens)).decode()[1:]

    # ---- one chunk of a longer text: `text` starts `lead` characters before it -----------------

    def cuts(self, text: str, lead: int) -> list[int]:
        """Nodes after the chunk's start that no piece spans, in order."""
        return [m.start() for m in self.v.segments.finditer(text) if m.start() > lead]

    def transfer(self, text: str, lead: int) -> np.ndarray:
        """[k, m]: best score from the node k before the start to the node m before the end."""
        size, end = self.v.longest, len(text)
        cuts = [c for c in self.cuts(text, lead) if c <= end - size + 1]
        out = np.full((size, size), NONE, np.int64)
        stop = cuts[0] if cuts else end
        tail, shared = None, 0
        if cuts:
            shared = sum(self.score(text[a:b]) for a, b in zip(cuts, cuts[1:]))
            best, _ = self.forward(text[cuts[-1] :], [0], 1)
            tail = np.array([best[end - cuts[-1] - m] for m in range(size)], np.int64)
        for k in range(min(size, lead + 1)):
            given = [int(NONE)] * (lead + 1)
            given[lead - k] = 0
            best, _ = self.forward(text[:stop], given, lead + 1)
            if cuts:
                if best[stop] > NONE:
                    out[k] = best[stop] + shared + tail
            else:
                out[k, : end - lead] = [
                    best[end - m] for m in range(min(size, end - lead))
                ]
        return np.maximum(out, NONE)

    def entries(self, text: str, lead: int, start: np.ndarray) -> np.ndarray:
        """For each node m before the end, the node before the start where its path enters."""
        size, end = self.v.longest, len(text)
        cuts = [c for c in self.cuts(text, lead) if c <= end - size + 1]
        stop = cuts[0] if cuts else end
        _, back = self.forward(text[:stop], self._given(start, lead), lead + 1)
        out = np.zeros(size, np.int64)
        for m in range(1 if cuts else min(size, end - lead)):
            out[m] = lead - self.trace(text[:stop], back, stop - m, lead)[1]
        return np.full(size, out[0]) if cuts else out

    def _given(self, start: np.ndarray, lead: int) -> list[int]:
        return [int(start[lead - i]) if lead - i < len(start) else int(NONE) for i in range(lead + 1)]

    def tokens(self, text: str, lead: int, start: np.ndarray, exit_node: int) -> np.ndarray:
        """The chunk's pieces: from where its path enters to `exit_node` before the end."""
        end = len(text) - exit_node
        cuts = [c for c in self.cuts(text, lead) if c <= len(text) - self.v.longest + 1]
        stop = cuts[0] if cuts else end
        _, back = self.forward(text[:stop], self._given(start, lead), lead + 1)
        parts = [self.trace(text[:stop], back, stop, lead)[0]]
        if cuts:
            parts += [self.segments[text[a:b]] for a, b in zip(cuts, cuts[1:])]
            last = text[cuts[-1] : end]
            _, back = self.forward(last, [0], 1)
            parts.append(self.trace(last, back, len(last), 0)[0])
        return np.fromiter(itertools.chain.from_iterable(parts), np.int32)


# ---- associative scans in Spark ----------------------------------------------------------------


def max_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a[:, :, None] + b[None, :, :]).max(1), NONE)


def _chain(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """First map a, then map b."""
    return b[a]


def scan(rows: DataFrame, width: int, forward: bool) -> DataFrame:
    """(key, c, at): what precedes (forward) or follows each chunk, combined.

    `rows`: (key, c, item binary). Forward, items are matrices and `at` is the vector of scores
    at the chunk's start; backward, items are maps and `at` is the chunk's exit node. Items of a
    block are combined first, then blocks of a document, then the result goes down again.
    """
    blocks = rows.withColumn("block", F.expr(f"c div {BLOCK}"))

    def items(t: pa.Table, order: str):
        t = t.sort_by([(order, "ascending" if forward else "descending")])
        arrays = [np.frombuffer(x.as_py(), np.int64) for x in t.column("item")]
        return t, [a.reshape(width, width) if forward else a for a in arrays]

    def combine(t: pa.Table) -> pa.Table:
        t, arrays = items(t, "c")
        whole = arrays[0]
        for a in arrays[1:]:
            whole = max_plus(whole, a) if forward else _chain(whole, a)
        return pa.table({"key": t.column("key")[:1], "block": t.column("block")[:1],
                         "item": pa.array([whole.tobytes()], pa.binary())})

    def walk(arrays, at):
        out = []
        for a in arrays:
            out.append(at)
            at = np.maximum((at[:, None] + a).max(0), NONE) if forward else a[at]
        return out

    def initial():
        if not forward:
            return np.zeros(1, np.int64)
        start = np.full(width, NONE, np.int64)
        start[0] = 0
        return start

    def top(t: pa.Table) -> pa.Table:
        t, arrays = items(t, "block")
        found = [x.tobytes() for x in walk(arrays, initial())]
        return pa.table({"key": t.column("key"), "block": t.column("block"),
                         "at": pa.array(found, pa.binary())})

    def down(t: pa.Table) -> pa.Table:
        t, arrays = items(t, "c")
        begin = np.frombuffer(t.column("at")[0].as_py(), np.int64)
        found = [x.tobytes() for x in walk(arrays, begin)]
        return pa.table({"key": t.column("key"), "c": t.column("c"),
                         "at": pa.array(found, pa.binary())})

    whole = blocks.groupBy("key", "block").applyInArrow(
        combine, "key string, block long, item binary"
    )
    tops = whole.groupBy("key").applyInArrow(top, "key string, block long, at binary")
    return (
        blocks.join(tops, ["key", "block"])
        .groupBy("key", "block")
        .applyInArrow(down, "key string, c long, at binary")
    )


def encode_giants(giants: DataFrame, vocabulary: Vocabulary, chunk: int = CHUNK) -> DataFrame:
    """(key, tokens) from distinct (key, text)."""
    spark = giants.sparkSession
    shared = share(spark, vocabulary)
    size = vocabulary.longest

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text")):
                text = marked(text.as_py())
                edges = list(range(0, max(1, len(text) - chunk // 2), chunk)) + [len(text)]
                for lo in range(0, len(edges) - 1, 64):
                    spans = list(enumerate(zip(edges, edges[1:])))[lo : lo + 64]
                    leads = [min(a, size - 1) for _, (a, _) in spans]
                    parts = [text[a - d : b] for (_, (a, b)), d in zip(spans, leads)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([key] * len(spans), pa.string()),
                            pa.array([c for c, _ in spans], pa.int64()),
                            pa.array(leads, pa.int32()),
                            pa.array([p.replace(LITERAL, "\x00") if LITERAL in p else p for p in parts]),
                            pa.array([[i for i, x in enumerate(p) if x == LITERAL] if LITERAL in p else [] for p in parts], pa.list_(pa.int32())),
                        ],
                        names=["key", "c", "lead", "part", "literals"],
                    )

    chunks = scratch(
        giants.mapInArrow(cut, "key string, c long, lead int, part string, literals array<int>"),
        "chunks",
    )

    def per_chunk(batches, work, kind):
        coder = Coder(shared_value(shared))
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                part = row["part"]
                if row["literals"]:
                    letters = list(part)
                    for i in row["literals"]:
                        letters[i] = LITERAL
                    part = "".join(letters)
                found.append(work(coder, part, row))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("c"), pa.array(found, kind)],
                names=["key", "c", "item"],
            )

    def vector(row, name="start"):
        return np.frombuffer(row[name], np.int64)

    def matrices(batches):
        return per_chunk(batches, lambda k, t, r: k.transfer(t, r["lead"]).tobytes(), pa.binary())

    def maps(batches):
        return per_chunk(
            batches, lambda k, t, r: k.entries(t, r["lead"], vector(r)).tobytes(), pa.binary()
        )

    def traces(batches):
        return per_chunk(
            batches,
            lambda k, t, r: k.tokens(t, r["lead"], vector(r), int(vector(r, "exit")[0])),
            pa.list_(pa.int32()),
        )

    binary = "key string, c long, item binary"
    made = scratch(chunks.mapInArrow(matrices, binary), "transfer")
    starts = scratch(scan(made, size, True).withColumnRenamed("at", "start"), "starts")
    started = chunks.join(starts, ["key", "c"])
    entered = scratch(started.mapInArrow(maps, binary), "entries")
    exits = scan(entered, size, False).withColumnRenamed("at", "exit")
    traced = started.join(exits, ["key", "c"]).mapInArrow(
        traces, "key string, c long, item array<int>"
    )
    listed = F.sort_array(F.collect_list(F.struct("c", "item")))
    return traced.groupBy("key").agg(
        F.flatten(F.transform(listed, lambda x: x["item"])).alias("tokens")
    )


ADDED = [
    StructField("n_tokens", LongType()),
    StructField("tokens", ArrayType(IntegerType())),
    StructField("decoded_sha256", StringType()),
]


def encode(
    docs: DataFrame, text: str = "text", model_file: str = MODEL_FILE, chunk: int = CHUNK
) -> DataFrame:
    """`docs` without the text, with tokens, their number, and the digest of the decoded tokens."""
    bounded_batches(docs.sparkSession)
    vocabulary = Vocabulary.load(model_file)
    shared = share(docs.sparkSession, vocabulary)
    added = {f.name for f in ADDED}
    kept = [f for f in docs.schema.fields if f.name != text and f.name not in added]
    names = [f.name for f in kept]
    docs = docs.select(*names, text)

    def finish(batch, tokens, coder):
        digests = [
            None if t is None else hashlib.sha256(coder.decode(t.tolist()).encode()).hexdigest()
            for t in tokens
        ]
        sizes = [None if t is None else len(t) for t in tokens]
        return pa.RecordBatch.from_arrays(
            [batch.column(n) for n in names]
            + [pa.array(sizes, pa.int64()), pa.array(tokens, pa.list_(pa.int32())),
               pa.array(digests, pa.string())],
            names=names + [f.name for f in ADDED],
        )

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared_value(shared))
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                texts = part.column(text).to_pylist()
                yield finish(part, [None if t is None else coder.encode(t) for t in texts], coder)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared_value(shared))
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                tokens = [np.asarray(t.values) for t in part.column("_tokens")]
                yield finish(part, tokens, coder)

    schema = StructType(kept + ADDED)
    giant = F.char_length(text) > chunk
    direct = docs.where(~giant | F.col(text).isNull()).mapInArrow(short, schema)
    long_docs = docs.where(giant).withColumn("_key", F.sha2(F.encode(text, "utf-8"), 256))
    distinct = (
        long_docs.select(F.col("_key").alias("key"), F.col(text).alias("text"))
        .dropDuplicates(["key"])
    )
    coded = encode_giants(distinct, vocabulary, chunk).select(
        F.col("key").alias("_key"), F.col("tokens").alias("_tokens")
    )
    scanned = long_docs.drop(text).join(coded, "_key").select(*names, "_tokens")
    return direct.unionByName(scanned.mapInArrow(joined, schema))


def op6_piece_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs).select("doc_id", "n_tokens", "tokens", "decoded_sha256")
