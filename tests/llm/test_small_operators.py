"""Archives, URL filters, fingerprints, mixing and search against brute force on small tables."""

import hashlib
import random

import numpy as np
import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from orderloom.llm import entropy_mix, hilbert_search, merkle, queries, url_filters, warc
from tests.compare import connect, differences

PAGES = "page_id long, url string, html string, lang string"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, small, name):
    result = queries.QUERIES[name](spark, small)
    assert differences(result, queries.ORACLE_SQL[name], connect(small)) == []


# ---- archives --------------------------------------------------------------------------------


@pytest.fixture()
def folder(tmp_path):
    return f"file://{tmp_path}/warc"


def archive(spark, folder, rows, **options):
    index = warc.write_bundles(spark.createDataFrame(rows, PAGES), folder, **options)
    return spark.createDataFrame(index.toPandas(), warc.INDEX) if rows else index


def test_archive_round_trip_with_nulls_ties_and_long_payloads(spark, folder):
    big = "<p>größe</p>" * 50_000
    rows = [
        (3, "http://a/", big, "x"), (1, None, big, None), (2, "http://b/\r\nX: y", "", None),
        (4, "http://c/", None, None), (None, "http://d/", big, None), (None, None, "only", None),
        (5, "u", "\r\n\r\n", None), (5, "u", "\r\n\r\n", None),
    ]
    index = archive(spark, folder, rows, frame_bytes=1000, bundle_bytes=3000)
    got = {}
    for r in warc.read_bundles(index, folder).collect():
        got.setdefault(r.page_id, []).append(tuple(r)[1:])
    size, code = len(big.encode()), warc.base32_sha1(big.encode())
    assert got[1] == [(size, code, "response", None)]
    assert got[3] == [(size, code, "revisit", 1)]
    nothing = warc.base32_sha1(b"")
    assert got[2] == [(0, nothing, "response", None)]
    assert got[4] == [(0, nothing, "revisit", 2)]
    assert [x[2] for x in got[5]] == ["response", "response"]
    assert sorted(x[2] for x in got[None]) == ["response", "revisit"]


def test_one_record_is_read_by_its_offsets_and_the_seek_table_holds(spark, folder):
    rows = [(i, f"http://h/{i}", f"page {i} " * 40, None) for i in range(50)]
    index = archive(spark, folder, rows, frame_bytes=2000).collect()
    for r in index:
        record = warc.read_record(
            folder, r.bundle, r.frame_at, r.frame_size, r.record_at, r.record_size
        )
        assert record["payload"].decode() == f"page {record['page_id']} " * 40
    fs, root = pafs.FileSystem.from_uri(folder)
    for bundle in {r.bundle for r in index}:
        with fs.open_input_file(f"{root}/{bundle}") as file:
            frames = warc.read_seek_table(file, file.size())
        held = {(r.frame, r.frame_at, r.frame_size) for r in index if r.bundle == bundle}
        assert held == {(i, at, packed) for i, (at, packed, _) in enumerate(frames)}


def test_small_payloads_below_the_least_size_are_all_responses(spark, folder):
    rows = [(1, None, "ab", None), (2, None, "ab", None), (3, None, "abcd", None), (4, None, "abcd", None)]
    index = archive(spark, folder, rows, least=3)
    kinds = {r.page_id: r.record_type for r in warc.read_bundles(index, folder).collect()}
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_an_empty_table_gives_an_empty_archive(spark, folder):
    assert archive(spark, folder, []).count() == 0


def test_a_damaged_payload_is_noticed(folder):
    record = warc.warc_record(1, None, b"abc", warc.base32_sha1(b"abc"), None)
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(b"abc", b"abd"))


# ---- URL filters -----------------------------------------------------------------------------


def test_urls_with_nulls_ports_case_and_repeated_rows(spark):
    urls = [
        None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/de/x?q#f", "http://a.net",
        "http://a.net/", "http://net/x", "http://a.example.net/en/", "http://org/fr/y",
        "http://x.org/fr", "http://casino.example.org/a", "http://mycasino.org/", "a://b://c/d",
        "http://free-bets.io#x", "http://free-bets.io#x", "http://h/" + "a/" * 20_000,
    ]
    pages = spark.createDataFrame(
        [(i, u, "mine") for i, u in enumerate(urls)], "page_id long, url string, host string"
    )
    got = url_filters.judge(pages, url_filters.default_rules(spark))
    rows = {r.page_id: (r.host, r.rule, r.action) for r in got.collect()}
    assert len(rows) == len(urls)
    assert [rows[i] for i in range(4)] == [("", None, None)] * 4
    assert rows[4] == ("www.example.com", "example.com/de/", "block")
    assert rows[5] == ("a.net", None, None) and rows[6] == ("a.net", "net/", "block")
    assert rows[7][1] == "net/" and rows[8] == ("a.example.net", "example.net/en/", "allow")
    assert rows[9] == ("org", "org/fr/", "allow") and rows[10][1] is None
    assert rows[11][1:] == ("~casino", "block") and rows[12][1] is None
    assert rows[13][0] == "b:" and rows[14] == rows[15] == ("free-bets.io", "~bets", "block")
    assert rows[16][0] == "h"
    none = pages.where("false")
    assert url_filters.judge(none, url_filters.default_rules(spark)).count() == 0


def test_a_rule_is_indexed_by_its_rarest_token_and_needs_one(spark):
    rules = spark.createDataFrame(
        [("r", "^a.*b", "block", 1, ["a", "b"])], url_filters.RULES
    )
    seen = spark.createDataFrame([("a",)] * 5 + [("b",)], "token string")
    assert url_filters.rule_index(rules, seen).first().token == "b"
    with pytest.raises(ValueError):
        url_filters.host_rule("block", "/x")


# ---- fingerprints ----------------------------------------------------------------------------


def test_neighbours_edits_and_equal_roots(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(merkle, "RANGE", 4)
    rng = random.Random(3)
    texts = ["", None, "a", "x" * 5000, "One. Two!\n\nThree?\n", "One. Two!\n\nThree?\n"] + [
        "".join(rng.choice("ab é.\n𝄞") for _ in range(rng.randint(0, 300))) for _ in range(20)
    ]
    rows = [(i * 3, t, None, None, 0) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in merkle.op3_merkle(spark, str(tmp_path)).collect()}
    down = sorted(((i, t or "") for i, t, *_ in rows), reverse=True)
    for at, (i, text) in enumerate(down):
        after = down[(at + 1) % len(down)][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (got[i].fingerprint == got[i].edited_fingerprint) == (edited == text)
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    for i, a in rows_by_text(rows).items():
        assert len({got[x].fingerprint for x in a}) == 1
    assert len({r.fingerprint for r in got.values()}) == len({t or "" for t in texts})


def rows_by_text(rows):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(t or "", []).append(i)
    return groups


def test_neighbours_with_null_and_repeated_ids_and_alone(spark):
    docs = spark.createDataFrame([(7, "a"), (7, "b"), (None, "c"), (2, "d")], "doc_id long, text string")
    got = merkle.with_next(docs, ["doc_id", "text"]).collect()
    assert len(got) == 4
    assert {(r.text, r.next_text) for r in got} >= {("d", "c")}
    assert sorted(r.next_text for r in got) == ["a", "b", "c", "d"]
    alone = merkle.with_next(docs.where("doc_id = 2"), ["doc_id", "text"]).first()
    assert alone.next_text == "d"
    assert merkle.with_next(docs.where("false"), ["doc_id", "text"]).count() == 0


def test_differing_branches_locate_the_edited_paragraphs(spark):
    a = "one\ntwo\n\nthree\nfour\n\nfive"
    b = "one\ntwo\n\nthree\nFOUR\n\nfive\n\nsix"
    df = spark.createDataFrame([(a, b)], "a string, b string")
    places = df.select(
        merkle.locate_edits(merkle.tree(F.col("a")), merkle.tree(F.col("b"))).alias("p")
    ).first()
    assert [tuple(x) for x in places.p] == [(1, 1, [0]), (3, 0, [0])]


def test_edits_are_located_down_to_the_leaf(spark):
    a = "First sentence. Second one here. A third one.\nother"
    b = "First sentence. Second one there. A third one.\nother"
    df = spark.createDataFrame([(a, b), (a, a)], "a string, b string")
    trees = [merkle.tree(F.col(c)) for c in "ab"]
    found = df.select(merkle.locate_edits(*trees).alias("p"), *[merkle.root(t) for t in trees])
    first, same = found.collect()
    assert [tuple(x) for x in first.p] == [(0, 0, [1])] and first[1] != first[2]
    assert same.p == [] and same[1] == same[2]


def test_thousands_of_rules_judge_as_brute_force(spark):
    rng = random.Random(2)
    word = lambda: rng.choice(["shop", "news", "a1", "blog", "x", "img", "cdn"]) + str(rng.randint(0, 40))
    hosts = [f"{word()}.{word()}.{rng.choice(['com', 'org', 'net'])}" for _ in range(900)]
    rules = {f"{h}/{rng.choice(['', word(), word() + '/'])}" for h in hosts for _ in range(3)}
    rules |= {h.partition(".")[2] + "/" for h in hosts[:200]}
    listed = [url_filters.host_rule(rng.choice(["allow", "block"]), r) for r in sorted(rules)]
    assert len(listed) > 2000
    urls = [
        f"https://{rng.choice(['', 'www.', 'm.'])}{rng.choice(hosts)}/{rng.choice([word(), word() + '/p', ''])}"
        for _ in range(400)
    ] + [None, "no scheme", "http://", f"http://{hosts[0].upper()}/?q"]
    rules_ = spark.createDataFrame(listed, url_filters.RULES)
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    for row in url_filters.judge(pages, rules_).collect():
        fits = [
            (-len(r), r, action)
            for r, _, action, *_ in listed
            if (row.host == r.partition("/")[0] or row.host.endswith("." + r.partition("/")[0]))
            and row.path.startswith("/" + r.partition("/")[2])
        ]
        best = min(fits, default=(0, None, None))
        assert (row.rule, row.action) == best[1:], row


# ---- mixing ----------------------------------------------------------------------------------


def brute_targets(sizes, weights=(1, 2, 3), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, left, open_ = {}, float(sum(sizes.values())), set(names)
    while open_:
        whole = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / whole > cap * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / whole for s in open_}
        for s in over:
            target[s] = float(cap * sizes[s])
        left -= sum(target[s] for s in over)
        open_ -= set(over)
        if left <= 0:
            return target | {s: 0.0 for s in open_}
    return target


def test_targets_are_met_with_hot_capped_null_and_empty_sources(spark):
    rng = random.Random(9)
    rows = [(i, "w " * rng.choice([1, 3, 10, 40]), None, "hot", 0) for i in range(900)]
    rows += [(1000 + i, "w " * rng.randint(1, 30), None, s, 0) for i in range(300) for s in ["a", "b", None]]
    rows += [(9000, "only three words", None, "tiny", 0), (9001, None, None, "void", 0),
             (9002, "   ", None, "void", 0), (None, "w w", None, "a", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    got = entropy_mix.mix(docs).collect()
    assert len(got) == len(rows)
    sizes, taken, target = {}, {}, {}
    for r in got:
        assert 0 <= r.copies <= 3
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r["size"] * r.copies
        target[r.source] = r.target
    assert {r.source: r.source_size for r in got} == sizes
    want = brute_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - want[s]) <= max(1, 0.001 * want[s])
    again = entropy_mix.mix(docs.repartition(3)).select("doc_id", "copies").collect()
    assert sorted(map(tuple, again), key=repr) == sorted(((r.doc_id, r.copies) for r in got), key=repr)


def test_mixing_an_empty_table(spark):
    assert entropy_mix.mix(spark.createDataFrame([], DOCS)).count() == 0


# ---- nearest neighbours ----------------------------------------------------------------------


def brute_nearest(vectors, queries_, k):
    out = {}
    for q in queries_:
        a = np.array(vectors[q], float)
        scored = []
        for i, v in vectors.items():
            if i != q and len(v) == len(a):
                b = np.array(v, float)
                scored.append((-float(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b)), i))
        out[q] = sorted((round(s, 12), i) for s, i in scored)[:k]
    return out


def test_recall_of_the_given_vectors(spark, small):
    got = {}
    for r in queries.QUERIES["op8_hilbert_search"](spark, small).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    rows = spark.read.parquet(f"{small}/embeddings.parquet").collect()
    vectors = {r.vec_id: r.embedding for r in rows}
    want = brute_nearest(vectors, [i for i in vectors if i % 50 == 0], 5)
    hits = sum(len(got[q] & {i for _, i in near}) for q, near in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_copies_ties_and_vectors_that_take_no_part(spark):
    rng = np.random.default_rng(2)
    vectors = {i: rng.normal(size=8).round(3).tolist() for i in range(100, 140)}
    vectors |= {i: [1.0] + [0.0] * 7 for i in range(40)}  # copies, with query 0 among them
    rows = [(i, v, "x") for i, v in vectors.items()]
    rows += [(50, None, "x"), (150, [0.0] * 8, "x"), (200, [float("nan")] * 8, "x"), (None, [1.0] * 8, "x"),
             (250, [1.0, None], "x"), (300, [], "x"), (350, [2.0, 1.0], "x"), (0, vectors[0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    # one range, so the search is exact
    got = hilbert_search.search(df, "vec_id", "embedding", F.col("vec_id") % 50 == 0, blocks=1).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert set(found) == {0, 100}
    assert found[0] == [1, 2, 3, 4, 5]
    f32 = {i: np.array(v, np.float32).tolist() for i, v in vectors.items()}
    assert found[100] == [i for _, i in brute_nearest(f32, [100], 5)[100]]
    assert hilbert_search.search(df.where("false"), "vec_id", "embedding", F.lit(True)).count() == 0


def test_the_curve_visits_neighbouring_cells():
    axes, bits = 3, 3
    grid = np.stack(np.meshgrid(*[range(1 << bits)] * axes), -1).reshape(-1, axes)
    key = hilbert_search.hilbert_index(grid, bits)
    assert sorted(key) == list(range(len(grid)))
    walk = grid[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_search_keeps_double_vectors_and_other_id_types(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 6))
    df = spark.createDataFrame(
        [(i, [float(v) for v in x[i]]) for i in range(60)], "vec_id int, embedding array<double>"
    )
    found = hilbert_search.search(df, "vec_id", "embedding", F.col("vec_id") % 20 == 0, k=3)
    assert dict(found.dtypes)["vec_id"] == "int"
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    for row in found.collect():
        assert abs(row.score - unit[row.query_id] @ unit[row.vec_id]) < 1e-12
    assert found.count() == 9
