"""Language identification by multilingual mixture inference.

Training counts hashed character n-grams (one to three letters with word borders) of every
labelled text, per language, as sums over all texts. A document is then a mixture: expectation
maximisation estimates the share of each language from the likelihoods of the document's
n-grams. The set of languages is chosen by penalised likelihood: starting from the best single
language, a language is added while twice the gain in log-likelihood exceeds `penalty` times the
logarithm of the document's n-grams. The predicted language has the largest share of the chosen
set; the score is that share.

Letters are hashed from the UTF-8 bytes, lower-cased for A-Z; every other byte run counts as a
word border. The model is one table of `BUCKETS` log-probabilities per language; its size is
fixed by these parameters and by the number of languages, not by the corpus.

Defined results: `und` with score 0 for a null text or one without a letter, and for every text
if nothing could be learned. A null language teaches nothing; a null doc_id is not held out and
teaches nothing in op10. Equal shares go to the language first by code point. Repeated rows each
get the same prediction. Very long texts are counted in slices. Extra columns are ignored; an
empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from orderloom.llm.common import bounded_batches, byte_view, row_slices, ship, table

ship(__name__)

BUCKETS = 1 << 15
SMOOTHING = 0.1
ROUNDS = 12
PENALTY = 4.0
UNKNOWN = "und"
# Positions of a text that are hashed at a time.
CHUNK = 1 << 20

_CODES = np.zeros(256, np.uint32)
_CODES[65:91] = _CODES[97:123] = np.arange(1, 27)
_CODES[128:256] = np.arange(27, 155)


def _gram_buckets(data: np.ndarray) -> np.ndarray:
    """Buckets of the one- to three-byte letter sequences of a text."""
    c = _CODES[data]
    # a run of other bytes is one border
    c = c[(c > 0) | np.r_[True, c[:-1] > 0]] if len(c) else c
    if len(c) == 0:
        return np.zeros(0, np.uint32)
    c = np.r_[np.uint32(0), c, np.uint32(0)]
    three = (c[:-2] * np.uint32(155) + c[1:-1]) * np.uint32(155) + c[2:]
    two = c[:-1] * np.uint32(155) + c[1:] + np.uint32(1 << 25)
    one = c[1:-1][c[1:-1] > 0] + np.uint32(1 << 26)
    grams = np.concatenate([three, two, one])
    return (grams * np.uint32(0x9E3779B1)) >> np.uint32(32 - 15)


def text_counts(data: np.ndarray) -> np.ndarray:
    """How often each bucket occurs in a text; long texts in chunks cut anywhere."""
    out = np.zeros(BUCKETS, np.int64)
    for lo in range(0, len(data), CHUNK):
        out += np.bincount(_gram_buckets(data[lo : lo + CHUNK]), minlength=BUCKETS)
    return out


def train(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, log-probabilities [language, bucket]) from all rows of (text, lang)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            data, at = byte_view(batch.column("text"))
            for i, lang in enumerate(batch.column("lang").to_pylist()):
                if lang not in held:
                    held[lang] = np.zeros(BUCKETS, np.int64)
                for lo in range(at[i], at[i + 1], CHUNK):
                    part = data[lo : min(at[i + 1], lo + CHUNK)]
                    held[lang] += np.bincount(_gram_buckets(part), minlength=BUCKETS)
        for lang, n in held.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some), pa.string()), pa.array(some), pa.array(n[some])],
                names=["lang", "bucket", "n"],
            )

    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang")
    summed = (
        rows.mapInArrow(count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    names = summed.column("lang").combine_chunks()
    languages = sorted(pc.unique(names).to_pylist())
    counts = np.full((len(languages), BUCKETS), SMOOTHING)
    if languages:
        row = np.asarray(pc.index_in(names, pa.array(languages)))
        np.add.at(counts, (row, np.asarray(summed.column("bucket"))), np.asarray(summed.column("n")))
    return languages, np.log(counts / counts.sum(1, keepdims=True))


def _mixture(lik: np.ndarray, weight: np.ndarray, owner: np.ndarray, start: np.ndarray):
    """EM for many documents at once: shares [docs, languages] and log-likelihoods.

    `lik`: likelihoods [entries, languages], scaled per entry; `owner`: the document of each
    entry; `start`: where each document's entries begin.
    """
    docs, langs = len(start), lik.shape[1]
    share = np.full((docs, langs), 1.0 / langs)
    total = np.add.reduceat(weight, start)
    for _ in range(ROUNDS if langs > 1 else 1):
        part = lik * share[owner]
        part *= (weight / part.sum(1))[:, None]
        share = np.add.reduceat(part, start) / total[:, None]
    fit = np.log((lik * share[owner]).sum(1)) * weight
    return share, np.add.reduceat(fit, start)


def infer(counts: list[tuple[np.ndarray, np.ndarray]], logs: np.ndarray, penalty: float):
    """Shares [docs, languages] of the languages chosen for each document of n-gram counts."""
    bucket = np.concatenate([b for b, _ in counts])
    weight = np.concatenate([n for _, n in counts]).astype(np.float64)
    sizes = np.array([len(b) for b, _ in counts])
    start = np.r_[0, np.cumsum(sizes)[:-1]]
    owner = np.repeat(np.arange(len(counts)), sizes)
    entry = logs.T[bucket]
    top = entry.max(1)
    lik = np.exp(entry - top[:, None])
    docs, langs = len(counts), len(logs)
    total = np.add.reduceat(weight, start)
    single = np.add.reduceat((entry - top[:, None]) * weight[:, None], start)
    order = single.argmax(1)
    chosen = np.zeros((docs, langs), bool)
    chosen[np.arange(docs), order] = True
    share = chosen.astype(np.float64)
    fit = single[np.arange(docs), order]
    if langs == 1:
        return share
    # the full mixture proposes which languages could be added
    proposed, _ = _mixture(lik, weight, owner, start)
    open_docs = np.arange(docs)
    while len(open_docs):
        rest = np.where(chosen[open_docs], -1.0, proposed[open_docs])
        add = rest.argmax(1)
        # however small its share, a language may pay the penalty in a long text
        able = rest[np.arange(len(open_docs)), add] > 0
        open_docs, add = open_docs[able], add[able]
        if len(open_docs) == 0:
            break
        trial = chosen[open_docs].copy()
        trial[np.arange(len(open_docs)), add] = True
        picked = np.isin(owner, open_docs)
        local = np.repeat(np.arange(len(open_docs)), sizes[open_docs])
        at = np.r_[0, np.cumsum(sizes[open_docs])[:-1]]
        masked = lik[picked] * trial[local] + 1e-300
        new_share, new_fit = _mixture(masked, weight[picked], local, at)
        better = 2 * (new_fit - fit[open_docs]) > penalty * np.log(total[open_docs])
        won = open_docs[better]
        chosen[won], share[won], fit[won] = trial[better], new_share[better], new_fit[better]
        open_docs = won
    return share


def predict(
    docs: DataFrame, model: tuple[list[str], np.ndarray], penalty: float = PENALTY
) -> DataFrame:
    """`docs` with lang_pred and score, from the column text alone."""
    languages, logs = model
    shared = docs.sparkSession.sparkContext.broadcast(logs)
    kept = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            lettered = pc.fill_null(pc.match_substring_regex(texts, r"\pL"), False)
            known = np.asarray(lettered.cast(pa.uint8())).astype(bool) & bool(languages)
            names = np.full(len(texts), UNKNOWN, object)
            score = np.zeros(len(texts))
            for lo, hi in row_slices(texts):
                data, at = byte_view(texts.slice(lo, hi - lo))
                rows, counts = [], []
                for i in range(lo, hi):
                    if known[i]:
                        n = text_counts(data[at[i - lo] : at[i - lo + 1]])
                        some = np.flatnonzero(n)
                        if len(some):
                            rows.append(i)
                            counts.append((some, n[some]))
                if rows:
                    share = infer(counts, shared.value, penalty)
                    names[rows] = np.array(languages, object)[share.argmax(1)]
                    score[rows] = np.clip(share.max(1), 0.0, 1.0)
            columns = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays(
                columns + [pa.array(names, pa.string()), pa.array(score)],
                names=[f.name for f in kept] + ["lang_pred", "score"],
            )

    schema = StructType(
        kept + [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    )
    return docs.select(*[f.name for f in kept]).mapInArrow(label, schema)


def third(doc_id: str = "doc_id") -> F.Column:
    return F.crc32(F.col(doc_id).cast("string")) % 3


def identify(docs: DataFrame, penalty: float = PENALTY) -> DataFrame:
    """Learns from all labelled rows and labels every row; a caller that holds rows out trains
    by itself, as op10 does."""
    bounded_batches(docs.sparkSession)
    model = train(docs.select("text", "lang"))
    return predict(docs, model, penalty)


def op10_language_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    bounded_batches(spark)
    model = train(docs.where(third() != 1).select("text", "lang"))
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id",
        F.coalesce(third() == 1, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
    )
