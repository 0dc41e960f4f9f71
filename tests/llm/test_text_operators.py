"""Resampling, personal data, tokens, n-gram join, languages and the pipeline on small tables."""

import hashlib
import random
import struct
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from orderloom.llm import components as star_contraction
from orderloom.llm import language_mix, ngram_join, pii_crf, piece_scan, resample
from orderloom.llm.common import word_hashes
from orderloom.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, None, None, len(t or "")) for i, t in rows], DOCS)


def test_word_hashes_follow_words_across_pieces_and_rows():
    texts = ["The CAT  sat", None, "", " \t", "the cat sat", "x" * 9000 + " cat", "é cat"]
    hashes, at = word_hashes(pa.array(texts))
    parts = [hashes[at[i] : at[i + 1]].tolist() for i in range(len(texts))]
    assert parts[0] == parts[4] and [len(p) for p in parts] == [3, 0, 0, 0, 3, 2, 2]
    assert parts[5][1] == parts[6][1] == parts[0][1]


# ---- n-gram join -----------------------------------------------------------------------------


def brute_components(rows):
    sets = []
    for i, t in rows:
        low = re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets.append((i, {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()))
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {(i, len(s), find(i)) for i, s in sets}


def test_components_match_brute_force_with_copies_chains_and_shared_passages(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    passage = [word() for _ in range(60)]
    texts = ["", None, "  \n", "a b", "A B", "b a", "One two three four five", "one two three four five six"]
    for _ in range(25):
        base = [word() for _ in range(rng.randint(6, 120))]
        for _ in range(rng.randint(1, 7)):
            texts.append(" ".join(base))
            base = list(base)  # a chain: each copy differs from the one before
            base[rng.randrange(len(base))] = word()
    hot = [word() for _ in range(150)]
    for _ in range(60):  # near copies of one text, of which not all pairs reach the threshold
        near = list(hot)
        for _ in range(rng.randint(0, 5)):
            near[rng.randrange(150)] = word()
        texts.append(" ".join(near))
    texts += [" ".join(passage + [word() for _ in range(rng.randint(1, 90))]) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    got = ngram_join.jaccard_components(docs_of(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted(brute_components(rows))


def test_join_with_repeated_and_null_ids_and_an_empty_table(spark):
    a, b = "a b c d e f g h i j", "k l m n o p q r s t"
    rows = [(5, a), (3, a), (5, b), (9, b), (9, b), (None, a), (7, "z")]
    got = ngram_join.jaccard_components(docs_of(spark, rows)).collect()
    held = sorted(((r.doc_id, r.component_id) for r in got), key=repr)
    assert held == sorted([(5, 3), (3, 3), (5, 3), (9, 3), (9, 3), (None, None), (7, 7)], key=repr)
    assert ngram_join.jaccard_components(docs_of(spark, [])).count() == 0


def test_texts_that_share_only_phrases_are_no_candidates(spark, monkeypatch):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    phrases = [[word() for _ in range(20)] for _ in range(60)]
    rows = []
    for i in range(60):  # a fifth of the n-grams of a text are its own, the rest of six phrases
        rows.append((i, " ".join(w for p in rng.sample(phrases, 6) for w in [*p, word()])))
    for i in range(6):  # a phrase in a text too long to link with these
        rows.append((60 + i, " ".join(phrases[i] + [word() for _ in range(400)])))
    written = Counter()
    scratch = ngram_join.scratch

    def counted(df, label):
        out = scratch(df, label)
        written[label] += out.count()
        return out

    monkeypatch.setattr(ngram_join, "scratch", counted)
    got = ngram_join.jaccard_components(docs_of(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted(brute_components(rows))
    assert written["columns"] > 0 and written["candidates"] == 0
    # links that remain are found where places are joined by shuffle, too
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", 0)
    near = [(i + 100, t.replace(t.split()[3], "changed", 1)) for i, t in rows]
    got = ngram_join.jaccard_components(docs_of(spark, rows + near)).collect()
    assert sorted(map(tuple, got)) == sorted(brute_components(rows + near))
    assert written["candidates"] > 0


def test_sizes_are_counted_while_tables_are_written(spark, monkeypatch):
    rng = random.Random(8)
    rows = []
    for i in range(20):
        base = [rng.choice("abcdefgh") * rng.randint(1, 9) for _ in range(rng.randint(9, 60))]
        rows += [(3 * i, " ".join(base)), (3 * i + 1, " ".join([*base, "z"])), (3 * i + 2, f"{i} alone")]
    rows += [(3, "another text of a repeated id"), (0, rows[3][1]), (None, rows[0][1])]
    docs = docs_of(spark, rows)

    def asked(df):
        raise AssertionError("a query of its own for a count")

    with monkeypatch.context() as patched:
        patched.setattr(type(docs), "count", asked)
        patched.setattr(type(docs), "first", asked)
        groups = ngram_join.jaccard_components(docs)
        kept = corpus_pipeline.near_duplicates(spark, docs_of(spark, rows[:60]), "")
        corpus_pipeline.near_duplicates(spark, docs, "")
    want = brute_components(rows[:60])
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _, c in want if i == c)
    held = {(r.doc_id, r.component_id) for r in groups.collect()}
    assert (4, 0) in held and (1, 0) in held and (None, None) in held


def test_components_without_links_and_of_stars_take_no_more_rounds(spark, monkeypatch):
    written = []
    kept = star_contraction.scratch
    monkeypatch.setattr(
        star_contraction, "scratch", lambda df, label: written.append(label) or kept(df, label)
    )
    assert components(spark.createDataFrame([(7, 7)], "a long, b long")).count() == 0
    assert len(written) == 1
    got = components(spark.createDataFrame([(1, 4), (1, 9), (9, 1)], "a long, b long"))
    assert sorted(map(tuple, got.collect())) == [(4, 1), (9, 1)]
    assert len(written) == 3


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {tuple(r) for r in got} >= {(i, 0) for i in range(1, 41)} | {(101, 100)}


# ---- personal data ---------------------------------------------------------------------------

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def brute_base(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            ok = (
                True,
                all(int(p) <= 255 for p in m.group().split(".") if kind == 1),
                12 <= len(d) <= 19 and pii_crf.luhn(d),
                9 <= len(d) <= 15,
            )[kind]
            if ok:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_match_the_plain_patterns():
    rng = random.Random(8)
    pieces = ["a@b.c", "@", ".", "-", "1", "255", "256", "4111 1111 1111 1111", "+", "(0", ") ", " ", "é",
              "1.2.3.4", "+49 30 123456", "x", "\n", "@a", "..", "00", "5500-0000-0000-0004"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert pii_crf.base_spans(text) == brute_base(text), text


def test_long_runs_cost_no_retries():
    text = "a" * 200_000 + " " + "1" * 200_000 + " " + "1." * 50_000 + "@" * 50_000
    assert pii_crf.base_spans(text) is not None


@pytest.fixture(scope="module")
def crf():
    return pii_crf.train(pii_crf.labelled_table())


def test_the_field_learns_held_out_sentences_and_spares_numbers(crf):
    held_out = pii_crf.labelled_table(rows_each=40, seed=77)
    paths = crf.decode([w for w, _ in held_out])
    right = sum(
        pii_crf.LABELS[p] == g for path, (_, gold) in zip(paths, held_out) for p, g in zip(path, gold)
    )
    assert right >= 0.95 * sum(len(g) for _, g in held_out)
    texts = ["write to jane (at) mail (dot) com today", "call (076) 555-8046 now", "page 12 of 2024-01-15", "the 12345 of"]
    found = pii_crf.crf_spans(texts, crf, [pii_crf.base_spans(t) for t in texts])
    assert [[texts[i][s:e] for s, _, e in f] for i, f in enumerate(found)] == [
        ["jane (at) mail (dot) com"], ["(076) 555-8046"], [], [],
    ]


def test_shapes_cover_long_words():
    start = "ab/" * 40
    assert pii_crf.shape(start + "12@c.de") == "x/" * 40 + "dd@x.x"
    assert pii_crf.features(start + "x@y") != pii_crf.features(start + "x=y")


def test_viterbi_matches_all_paths(crf):
    words = ["call", "(076)", "555-8046"]
    e = crf.scores([words])[0]
    k = len(pii_crf.LABELS)
    best = max(
        (crf.move[-1, a] + e[0, a] + crf.move[a, b] + e[1, b] + crf.move[b, c] + e[2, c], (a, b, c))
        for a in range(k) for b in range(k) for c in range(k)
    )
    assert tuple(crf.decode([["x"] * 9, words])[1]) == best[1]


def test_spans_of_a_table_with_nulls_ties_and_clashing_columns(spark, crf):
    rows = [(1, None), (2, ""), (3, "mail a@b.co, +1 (076) 555-8046"), (3, "mail a@b.co, +1 (076) 555-8046"),
            (None, "x " * 50_000 + "1.2.3.4")]
    docs = docs_of(spark, rows).withColumn("spans", F.lit("mine"))
    got = pii_crf.find(docs, crf).collect()
    empty = hashlib.sha256(b"").hexdigest()
    by = sorted(((r.doc_id, r.spans, r.n_email, r.n_phone, r.n_ip) for r in got), key=repr)
    twice = (3, "email:5:11,phone:13:30", 1, 1, 0)
    assert by == sorted([(1, "", 0, 0, 0), (2, "", 0, 0, 0), twice, twice,
                         (None, "ip:100000:100007", 0, 0, 1)], key=repr)
    assert {r.base_sha256 for r in got if r.doc_id in (1, 2)} == {empty}
    masked = pii_crf.find(docs, crf, mask=True).where("doc_id = 3").first()
    assert masked.text == "mail [EMAIL], [PHONE]"
    assert pii_crf.find(docs.where("false"), crf).count() == 0


# ---- tokens ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    return piece_scan.Vocabulary.load(piece_scan.MODEL_FILE)


def whole(coder, text):
    m = piece_scan.marked(text)
    return coder.trace(m, coder.forward(m, [0], 1)[1], len(m), 0)[0]


def awkward_texts():
    rng = random.Random(6)
    texts = ["".join(rng.choice("abc é\n梦▁ the\x00") for _ in range(rng.randint(1, 400))) for _ in range(30)]
    return texts + ["nospaceatall" * 40, "a" * 300, " " * 200, "\n" * 90 + "x", "▁▁ ▁", "𝄞" * 99]


def test_segmentation_is_the_best_of_all(vocabulary):
    coder = piece_scan.Coder(vocabulary)
    for text in ["hello", "the cat", "éab", "aaaa  b"]:
        m = piece_scan.marked(text)

        def best(i):
            if i == len(m):
                return 0
            steps = []
            for j in range(i + 1, len(m) + 1):
                s = vocabulary.score.get(m[i:j], vocabulary.unknown if j == i + 1 else None)
                if s is not None:
                    steps.append(s + best(j))
            return max(steps)

        assert coder.forward(m, [0], 1)[0][-1] == best(0)


def test_chunks_give_the_tokens_of_the_whole_text(spark, vocabulary):
    coder = piece_scan.Coder(vocabulary)
    texts = awkward_texts()
    rows = [(i, t) for i, t in enumerate(texts + texts[:3])]
    for chunk in (40, 90):
        got = piece_scan.encode(docs_of(spark, rows), chunk=chunk).collect()
        assert len(got) == len(rows)
        for r in got:
            text = dict(rows)[r.doc_id]
            assert list(r.tokens) == whole(coder, text)
            assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_blocks_of_chunks_are_combined(spark, vocabulary, monkeypatch):
    monkeypatch.setattr(piece_scan, "BLOCK", 3)
    text = "this is nospaceatall" * 50 + "x" * 700
    got = piece_scan.encode(docs_of(spark, [(1, text)]), chunk=64).first()
    assert list(got.tokens) == whole(piece_scan.Coder(vocabulary), text)


def test_tokens_of_nulls_and_empty_texts(spark):
    docs = docs_of(spark, [(1, None), (2, ""), (None, "a")]).withColumn("tokens", F.lit("mine"))
    got = {r.doc_id: r for r in piece_scan.encode(docs).collect()}
    assert got[1].tokens is None and got[1].n_tokens is None
    assert got[2].tokens == [] and got[2].n_tokens == 0
    assert got[None].n_tokens == 1
    assert piece_scan.encode(docs.where("false")).count() == 0


# ---- languages -------------------------------------------------------------------------------


def test_held_out_accuracy(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = language_mix.op10_language_mix(spark, small).join(docs.select("doc_id", "lang"), "doc_id")
    row = got.where("held_out").agg(
        F.avg(F.when(F.col("lang") == F.col("lang_pred"), 1.0).otherwise(0.0)), F.count("*")
    ).first()
    assert row[1] > 0 and row[0] >= 0.97


def test_mixtures_unknown_texts_and_clashing_columns(spark):
    english = "the cat and the dog with this house that was there " * 6
    german = "der hund und die katze mit dem haus das dort nicht war " * 6
    rows = [(i, english if i % 2 else german, "en" if i % 2 else "de") for i in range(20)]
    model = language_mix.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    texts = [english, german, english + german, None, "", "123 ... !", "é", english * 2000]
    docs = docs_of(spark, list(enumerate(texts))).withColumn("score", F.lit("mine"))
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_mix.predict(docs, model).collect()}
    assert got[0][0] == "en" and got[0][1] > 0.95 and got[1][0] == "de"
    assert 0.35 < got[2][1] < 0.65
    assert got[3] == got[4] == got[5] == ("und", 0.0)
    assert got[6][0] in ("en", "de") and got[7][0] == "en"
    assert language_mix.predict(docs.where("false"), model).count() == 0
    nothing = language_mix.train(docs.where("false").select("text", "lang"))
    assert {r.lang_pred for r in language_mix.predict(docs, nothing).collect()} == {"und"}


def test_the_pipeline_learns_from_rows_that_op10_holds_out_and_from_rows_without_an_id(spark):
    english = "the cat and the dog with this house that was there " * 6
    german = "der hund und die katze mit dem haus das dort nicht war " * 6
    french = "le chat et le chien dans la maison qui n'est pas ici " * 6
    held = [r[0] for r in spark.range(60).where(language_mix.third("id") == 1).collect()]
    other = [r[0] for r in spark.range(60).where(language_mix.third("id") != 1).collect()]
    rows = [(i, german, "de", None, 0) for i in held] + [(None, french, "fr", None, 0)] * 5
    rows += [(i, english, "en", None, 0) for i in other]
    got = corpus_pipeline.language_id(spark, spark.createDataFrame(rows, DOCS), "").collect()
    assert Counter((r.text, r.lang) for r in got) == Counter((r[1], r[2]) for r in rows)


def test_the_mixture_maximises_the_likelihood():
    rng = np.random.default_rng(0)
    logs = np.log(rng.dirichlet(np.ones(50), size=2))
    n = rng.multinomial(400, 0.3 * np.exp(logs[0]) + 0.7 * np.exp(logs[1]))
    lik = np.exp(logs.T)
    rounds = language_mix.ROUNDS
    share, fit = language_mix._mixture(lik, n.astype(float), np.zeros(50, int), np.array([0]))
    grid = np.linspace(0.001, 0.999, 999)
    best = max((float((n * np.log(lik @ [p, 1 - p])).sum()), p) for p in grid)
    assert rounds > 0 and abs(share[0, 0] - best[1]) < 0.05 and fit[0] >= best[0] - 0.5


def test_a_language_of_less_than_a_hundredth_is_found_in_a_long_text():
    rng = np.random.default_rng(1)
    words = rng.dirichlet(np.full(500, 0.1), size=3) + 1e-9
    logs = np.log(words / words.sum(1, keepdims=True))
    n = rng.multinomial(60_000, 0.993 * np.exp(logs[0]) + 0.007 * np.exp(logs[2]))
    some = np.flatnonzero(n)
    share = language_mix.infer([(some, n[some])], logs, language_mix.PENALTY)
    assert 0.003 < share[0, 2] < 0.01 and share[0, 1] == 0 and share[0, 0] > 0.99


# ---- resampling ------------------------------------------------------------------------------


def test_the_sample_is_exactly_the_largest_keys(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([0.0, 0.5, rng.random() * 1e6, -rng.random()])) for i in range(3000)]
    keyed = spark.createDataFrame(rows, "doc_id long, key double")
    for k in (0, 1, 700, 2999, 3000, 9999):
        got = sorted((r.key for r in resample.top_keys(keyed, k).collect()), reverse=True)
        assert got == sorted((x for _, x in rows), reverse=True)[:k]


def test_good_texts_are_kept_and_nulls_defined(spark):
    good = ["the cat and dog sat on a mat by the door " * 5 + str(i) for i in range(60)]
    bad = ["buy$$$ now%%% win&&& cash### " * 8 + str(i) for i in range(20)]
    rows = list(enumerate(good + bad)) + [(None, "the cat"), (500, None), (501, "")]
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(0, 80, 2)], "doc_id long, quality int, toxic int")
    docs = docs_of(spark, rows).withColumn("key", F.lit("mine"))
    got = [r.doc_id for r in resample.resample(docs, labels, k=63).collect()]
    assert len(got) == 63 and set(range(60)) <= set(got)
    assert resample.resample(docs.where("false"), labels).count() == 0
    assert resample.resample(docs, labels.where("false"), k=10).count() == 10
    again = [r.doc_id for r in resample.resample(docs.repartition(5), labels, k=63).collect()]
    assert sorted(again, key=repr) == sorted(got, key=repr)


# ---- the pipeline ----------------------------------------------------------------------------


def test_every_stage_takes_effect(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    junk = docs_of(spark, [(10_000, "123 456"), (10_001, None), (None, "")])
    docs = docs.unionByName(junk)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, small).cache()
        kept[name] = docs
        if name != "tokenize":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "language_id":
            assert docs.where("doc_id >= 10000 OR doc_id IS NULL").count() == 0
            assert docs.count() == before.count() - 3
        if name == "near_duplicates":
            want = ngram_join.jaccard_components(before).where("doc_id = component_id")
            assert sorted(r[0] for r in docs.select("doc_id").collect()) == sorted(
                r[0] for r in want.select("doc_id").collect()
            )
        if name == "personal_data":
            assert docs.count() == before.count()
            for r in docs.collect():
                assert pii_crf.base_spans(r.text or "") == [] and r.n_chars == len(r.text)
        if name == "tokenize":
            assert docs.count() == before.count()
            digests = sorted(r[0] for r in before.select(F.sha2("text", 256)).collect())
            assert sorted(r.decoded_sha256 for r in docs.collect()) == digests


def test_distinct_texts_of_one_id_stay_and_their_copies_go(spark):
    one = "a long passage about the harbour and its boats in the early winter morning"
    two = "quite another text on the cultivation of beans behind a small white house"
    rows = [(5, one, "en", "s", 1), (5, two, "en", "s", 1), (5, two, "en", "r", 1), (5, "", "en", "s", 0),
            (3, two, "en", "s", 1), (9, one, "en", "s", 1), (7, "alone", "en", "s", 1),
            (None, one, "en", "s", 1)]
    for part in (1, 3):
        docs = spark.createDataFrame(rows, DOCS).repartition(part)
        got = corpus_pipeline.near_duplicates(spark, docs, "").collect()
        assert set(map(tuple, got)) == {rows[0], rows[3], rows[4], rows[6], rows[7]}
        assert len(got) == 5
    docs = spark.createDataFrame(rows[1:3] + rows[:1], DOCS)
    got = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted(map(tuple, got)) == sorted([rows[0], rows[2]])


def test_each_row_without_an_id_keeps_its_own_copies(spark):
    # by weights 1 and 2, "a" is capped at 3 copies and "b" takes 80 of its 100 rows
    rows = [(None, f"a one two three {i}", "en", s, i) for s, n in (("a", 10), ("b", 100)) for i in range(n)]
    docs = spark.createDataFrame(rows, DOCS)
    mixed = corpus_pipeline.mix_sources(spark, docs, "").collect()
    taken = Counter(r.source for r in mixed)
    assert taken == {"a": 30, "b": 80}
    assert {tuple(r) for r in mixed} <= set(rows)
    assert max(Counter(mixed).values()) == 3
    assert all(r.source == "a" or n == 1 for r, n in Counter(mixed).items())


def test_stages_of_an_empty_table(spark, small):
    docs = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small)
    assert docs.count() == 0


def unigram_file(path, pieces):
    """A piece model of the unigram kind with byte fallback, as its format writes it."""

    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    def field(number, data):
        return varint(number << 3 | 2) + varint(len(data)) + data

    def flag(number, value):
        return varint(number << 3) + varint(value)

    def piece(text, score, kind):
        return field(1, field(1, text.encode()) + varint(2 << 3 | 5) + struct.pack("<f", score) + flag(3, kind))

    held = [piece("<unk>", 0, 2)] + [piece(f"<0x{b:02X}>", 0, 6) for b in range(256)]
    held += [piece(p, s, 1) for p, s in pieces.items()]
    trainer = flag(3, 1) + flag(35, 1)
    normalizer = field(1, b"identity") + flag(3, 1) + flag(4, 0) + flag(5, 1)
    path.write_bytes(b"".join(held) + field(2, trainer) + field(3, normalizer))


def test_a_unigram_model_gives_the_tokens_of_its_library(spark, small, tmp_path):
    import sentencepiece

    rng = random.Random(11)
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").limit(60).collect()]
    pieces = {c: -12.0 - rng.random() for c in sorted(set("".join(texts))) if c.isalpha()}
    pieces["▁"] = -11.5
    for text in texts:
        for word in text.split(" ")[:80]:
            for _ in range(3):
                a = rng.randrange(len(word) or 1)
                part = ("▁" if a == 0 else "") + word[a : a + rng.randint(1, 5)]
                if "\n" not in part and len(part) > 1:
                    pieces.setdefault(part, -4.0 - 7 * rng.random())
    unigram_file(tmp_path / "u.model", pieces)
    file = str(tmp_path / "u.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=file)
    coder = piece_scan.Coder(piece_scan.Vocabulary.load(file))
    same = [list(coder.encode(t)) == sp.encode(t) for t in texts]
    assert sum(same) >= 59, same  # sums of the library are 32-bit floats: near ties may differ
    docs = spark.createDataFrame(list(enumerate(texts[:8])), "doc_id long, text string")
    whole = {r.doc_id: r.tokens for r in piece_scan.encode(docs, model_file=file).collect()}
    cut = {r.doc_id: r.tokens for r in piece_scan.encode(docs, model_file=file, chunk=64).collect()}
    assert whole == cut
