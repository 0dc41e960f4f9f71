"""Hard negatives, cross-tokenizer alignment and decontamination against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import cross_tokens, decontaminate, hard_negatives

# ---- hard negatives --------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, rank string"


def fixture_vectors(n, dim, seed=1, clusters=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dim))
    x = centres[rng.integers(clusters, size=n)] + 0.3 * rng.normal(size=(n, dim))
    return [
        (i, [float(np.float32(v)) for v in x[i]], int(i % 4), "extra") for i in range(n)
    ]


def brute_negatives(rows, positives=5, negatives=3, every=10):
    held = []
    for ident, vector, label, _ in rows:
        if ident is None or label is None or vector is None:
            continue
        if any(v is None or not math.isfinite(v) for v in vector):
            continue
        held.append((ident, tuple(math.floor(256 * v) for v in vector), label))
    held = sorted(set(held))
    out = []
    for a, q, label in held:
        if a % every:
            continue
        scored = [
            (-sum(x * y for x, y in zip(q, p)), b, c)
            for b, p, c in held
            if b != a and len(p) == len(q)
        ]
        same = sorted((s, b) for s, b, c in scored if c == label)[:positives]
        for s, b in same:
            fits = sorted(
                (t, n) for t, n, c in scored if c != label and -50 * s <= -100 * t <= -95 * s
            )
            out += [(a, b, i + 1, n, -s, -t) for i, (t, n) in enumerate(fits[:negatives])]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame(rows, VECTORS)
    out = hard_negatives.mine(
        df, "vec_id", "embedding", "label", F.col("vec_id") % 10 == 0, **options
    )
    columns = "anchor_id positive_id rank negative_id positive_score negative_score".split()
    return sorted(tuple(r) for r in out.select(*columns).collect())


def test_negatives_equal_brute_force_over_several_levels(spark):
    rows = fixture_vectors(900, 12)
    # copies, ties, nulls, other lengths, a zero vector, a repeated row, ids with two vectors
    rows += [(2000 + i, rows[0][1], i % 4, None) for i in range(60)]
    rows += [(3000, None, 1, None), (3010, rows[1][1], None, None), (None, rows[1][1], 1, None)]
    rows += [(3020, [1.0, None] + [0.0] * 10, 1, None), (3030, [math.inf] * 12, 1, None)]
    rows += [(3040, [0.0] * 12, 1, None), rows[10], (20, rows[7][1], 3, None)]
    rows += [(4000 + i, [1.0 + i, 2.0], i % 2, None) for i in range(12)]
    expected = brute_negatives(rows)
    assert mined(spark, rows) == expected and len(expected) > 500
    assert mined(spark, rows, first_level=8) == expected


def test_few_candidates_and_empty_tables(spark):
    rows = [(0, [1.0, 0.0], 1, None), (1, [1.0, 0.1], 1, None), (2, [0.8, 0.0], 2, None)]
    assert mined(spark, rows) == brute_negatives(rows) != []
    assert mined(spark, rows[:1]) == [] == mined(spark, [])


def test_bounds_hold_and_windows_of_structured_vectors_are_left_out():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(32, 24))
    x = np.floor(256 * (centres[np.arange(1024) // 32] + 0.05 * rng.normal(size=(1024, 24))))
    refs = hard_negatives.references(x.astype(int).tolist(), 16)
    angles = hard_negatives.angles_to(x, refs, 16)
    order = np.lexsort((angles.min(1), angles.argmin(1)))
    x, angles = x[order], angles[order]
    labels = np.zeros(1024, np.int64)
    block = {"ids": np.arange(1024), "labels": labels, "norms": np.linalg.norm(x, axis=1),
             "vectors": x, "angles": angles}
    ask = {**{k: v[::16] for k, v in block.items()}}
    edges = hard_negatives.window_edges(labels, angles.argmin(1), 16)
    least, most = hard_negatives.bounds(block, ask, edges)
    scores = ask["vectors"] @ x.T
    for w, (a, b) in enumerate(zip(edges, edges[1:])):
        assert (least[:, w] <= scores[:, a:b].min(1)).all()
        assert (most[:, w] >= scores[:, a:b].max(1)).all()
    fifth = np.sort(scores, axis=1)[:, -6].astype(np.int64)[:, None]
    ask |= {"low": fifth, "high": np.full_like(fifth, hard_negatives.MOST)}
    hits, scored = hard_negatives.block_hits(block, ask, True, 5)
    assert scored < 0.5 * scores.size
    assert len(hits["score"]) == 5 * len(fifth)


def test_large_scores_are_exact_integers():
    a = np.array([[1 << 27, (1 << 27) - 1]], np.int64)
    assert hard_negatives.integer_scores(a, a, 2.0**55)[0, 0] == int(a[0, 0]) ** 2 + int(a[0, 1]) ** 2


# ---- cross-tokenizer alignment ---------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, row string"


@pytest.fixture(scope="module")
def held():
    return cross_tokens.tables()


def brute_tokens(text, held, a, b):
    if not text:
        return [], []
    x, y = a([text])[0], b([text])[0]
    whole = (" " + text).encode()
    if b"".join(held["a_bytes"][i] for i in x) != whole:
        return [], []
    if b"".join(held["b_bytes"][i] for i in y) != whole:
        return [], []
    return x, y


def brute_alignment(texts, held):
    a, b = cross_tokens.encoders(held)
    per_doc, seen = [], defaultdict(set)
    for n, text in enumerate(texts):
        x, y = brute_tokens(text, held, a, b)
        spans = []
        for ids, known in ((x, held["a_bytes"]), (y, held["b_bytes"])):
            at, out = 0, []
            for i in ids:
                out.append((at, at + len(known[i]), i))
                at += len(known[i])
            spans.append(out)
        links = [(i, j) for s, e, i in spans[0] for u, v, j in spans[1] if s < v and u < e]
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, start = [], 0
        for cut in cuts:
            sides = [[str(i) for s, e, i in side if start < e <= cut] for side in spans]
            groups.append("|".join(",".join(s) for s in sides))
            start = cut
        for pair in set(links):
            seen[pair].add(n)
        per_doc.append((len(x), len(y), len(cuts), links, ";".join(groups)))
    count = {p: len(d) for p, d in seen.items()}
    most = defaultdict(int)
    for (i, _), c in count.items():
        most[i] = max(most[i], c)
    out = []
    for n_a, n_b, n_groups, links, listed in per_doc:
        digest = hashlib.sha256(listed.encode()).hexdigest() if listed else ""
        best = sum(count[p] == most[p[0]] for p in links)
        out.append((n_a, n_b, n_groups, len(links), best, sum(count[p] for p in links), digest))
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    None, "", " ", "  two  spaces ", "\n\n\ttabs", "naïve Größe, être", "日本語 текст", "😀👍🏽", "▁x",
    "<s>hi</s><|endoftext|>", "<0x41>", "a\x00b", "x" * 700, "aaaa" * 50, "It's we'll I'M", "ﬁ é́",
    "1234567 89", " line nbsp", "same text", "same text",
]


def test_alignment_equals_brute_force(spark, small, held):
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").limit(25).collect()]
    texts = [t[:1500] for t in texts] + ODD
    rows = [(i if i % 7 else None, t, None, "clash") for i, t in enumerate(texts)]
    got = cross_tokens.cross_tokens(spark.createDataFrame(rows, DOCS))
    assert Counter(tuple(r) for r in got.select(*COLUMNS).collect()) == Counter(
        brute_alignment(texts, held)
    )


def test_ranks_give_the_ids_of_the_files_own_library(spark, small, held):
    assert held["ranks"]
    with open(cross_tokens.A_FILE, "rb") as file:
        other, _ = cross_tokens.encoders({**held, "ranks": None, "a_data": file.read()})
    ranked, _ = cross_tokens.encoders(held)
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    texts += [t for t in ODD if t]
    rng = random.Random(5)
    letters = "aB1 \t\n'’.,-_éßжЖ漢字🙂́ ​ſĿ²½ "
    texts += ["".join(rng.choices(letters, k=80)) for _ in range(300)]
    assert ranked(texts) == other(texts)


def test_groups_are_written_for_many_texts_at_once(held):
    a, b = cross_tokens.encoders(held)
    texts = ["naïve Größe", "two words", "x"]
    ids = a(texts), b(texts)
    lens = [np.array([len(x) for x in held[k]]) for k in ("a_bytes", "b_bytes")]
    listed = [bytes(x).decode() for x in cross_tokens.group_texts(cross_tokens.align(*ids, *lens))]
    for text, groups, x, y in zip(texts, listed, *ids):
        sides = [g.split("|") for g in groups.split(";")]
        assert [int(i) for s, _ in sides for i in s.split(",")] == x
        assert [int(i) for _, s in sides for i in s.split(",")] == y
        for s, t in sides:
            bytes_of = lambda ids, k: b"".join(held[k][int(i)] for i in ids.split(","))
            assert bytes_of(s, "a_bytes") == bytes_of(t, "b_bytes")


def test_identity_links_outside_single_groups_count_once_per_document():
    a_len, b_len = np.array([1, 2]), np.array([1, 2])  # ids 0: one byte, 1: two bytes
    found = cross_tokens.align([[1, 1]], [[0, 1, 0]], a_len, b_len)
    links = list(zip(found["link_a"].tolist(), found["link_b"].tolist()))
    assert links == [(1, 0), (1, 1), (1, 1), (1, 0)] and found["cut"].sum() == 1
    _, a, b, n = cross_tokens.pairs_by_text(found["text"], found["link_a"], found["link_b"], (2, 2))
    assert list(zip(a, b, n)) == [(1, 0, 2), (1, 1, 2)]


def test_alignment_of_an_empty_table(spark):
    assert cross_tokens.cross_tokens(spark.createDataFrame([], DOCS)).count() == 0


# ---- decontamination -------------------------------------------------------------------------

ITEMS = "item_id long, text string, n int"
# only A-Z are lower-cased: an É stays one
UPPER = str.maketrans("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def split(text):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute_hits(docs, items, width=10):
    out = []
    for _, text, *_ in docs:
        words, hit, named = split(text), set(), set()
        for ident, item, *_ in items:
            w = split(item)
            n = min(width, len(w))
            windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
            for i in range(len(words) - n + 1 if n else 0):
                if tuple(words[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    if ident is not None:
                        named.add(str(ident))
        digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        out.append((len(words), len(hit), len(named), digest))
    return out


def corpus():
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdeé9", k=rng.randint(1, 4)))
    text = lambda n: " ".join(word() for _ in range(n))
    common = text(14)
    items = [(i, f"{text(5)} {common} {text(12)}", 1) for i in range(9)]
    items += [(20, text(30), 1), (21, "Short Item", 1), (22, "one", 1), (None, text(12), 1)]
    items += [(23, None, 1), (24, "", 1), (25, " .,; ", 1), (20, text(11), 1), (26, items[9][1], 1)]
    docs = [(i, text(rng.randint(0, 60)), None, "x") for i in range(60)]
    for k, (_, item, _) in enumerate(items[:13]):
        docs.append((100 + k, f"{text(8)}!{(item or '').translate(UPPER)}? {text(6)}", None, "x"))
    docs += [(200, None, None, "x"), (201, "", None, "x"), (None, items[9][1], None, "x")] * 2
    docs.append((300, " ".join(f"{text(400)} {items[9][1]}" for _ in range(40)), None, "x"))
    return docs, items


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 2000])
def test_hits_equal_brute_force(spark, block_bytes):
    docs, items = corpus()
    found = decontaminate.contamination(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), block_bytes=block_bytes
    )
    rows = decontaminate.each_row(found).select(
        "n_words",
        decontaminate.covered(F.col("spans")),
        F.size("items"),
        F.sha2(F.array_join("items", ","), 256),
    )
    expected = brute_hits(docs, items)
    assert Counter(tuple(r) for r in rows.collect()) == Counter(expected)
    assert sum(h > 0 for _, h, _, _ in expected) > 10


def test_spans_or_documents_are_removed(spark):
    docs, items = corpus()
    d, i = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    dirty = [h > 0 for _, h, _, _ in brute_hits(docs, items)]
    left = decontaminate.decontaminate(d, i, "documents")
    assert left.columns == d.columns
    assert left.count() == dirty.count(False)
    cleaned = decontaminate.decontaminate(d, i, "spans")
    assert cleaned.count() == len(docs)
    by_id = {r.doc_id: r.text for r in cleaned.collect()}
    for (ident, text, *_), bad in zip(docs, dirty):
        if not bad:
            assert by_id[ident] == text
    source = dict((x[0], x[1]) for x in docs)
    words, gone = split(source[109]), split(items[9][1])
    assert split(by_id[109]) == words[:8] + words[8 + len(gone) :]


def test_many_copies_are_dealt_out_whole(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "COPIES", 3)
    docs = spark.createDataFrame([(None, "one two", None, None)] * 10 + [(1, "x", None, None)], DOCS)
    items = spark.createDataFrame([(1, "Two", 0)], ITEMS)
    rows = decontaminate.each_row(decontaminate.contamination(docs, items)).collect()
    assert Counter(r.doc_id for r in rows) == {None: 10, 1: 1}


def test_empty_tables_have_no_hits(spark):
    docs, items = corpus()
    d, none = spark.createDataFrame(docs, DOCS), spark.createDataFrame([], ITEMS)
    assert decontaminate.contamination(d, none).where("size(spans) > 0").count() == 0
    empty = spark.createDataFrame([], DOCS)
    assert decontaminate.contamination(empty, spark.createDataFrame(items, ITEMS)).count() == 0
