"""Vector, conversation and page operators, the queries and the pipeline."""

import gzip
import hashlib
import base64
import random

import numpy as np
import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF
from planledger.llm import exact_topk, preferences, queries, storage, vantage, vectors, warc

VECTORS = "vec_id long, embedding array<float>"


def vector_rows(n=700, width=20, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)).astype(np.float32)
    x[5::9] = x[5]  # many copies of one vector
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    odd = [(None, rows[0][1]), (9000, None), (9100, [None] * width), (9200, [float("nan")] * width), (9300, [float("inf")] * width),
           (9400, [0.0] * width), (9500, [1.0, 2.0]), (9501, [2.0, 1.0]), (9600, []), (9700, rows[3][1]), (9700, rows[3][1])]
    return rows + odd


def usable(rows, zero):
    return [(k, np.array(v, np.float64)) for k, v in rows
            if k is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all() and (zero or np.any(np.array(v)))]


def brute(rows, every, k, score, zero):
    own, out = usable(rows, zero), []
    for q, x in dict(own).items():
        if q % every == 0:
            found = sorted((-score(x, y), i) for i, y in own if i != q and len(y) == len(x))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


def test_exact_top_k(spark, monkeypatch):
    monkeypatch.setattr(vectors, "QUERY_BLOCK", 5)
    monkeypatch.setattr(exact_topk, "CHUNK", 64)
    rows = vector_rows()
    df = spark.createDataFrame(rows, VECTORS).withColumn("id", F.lit("clash")).repartition(5)
    got = exact_topk.exact_top_k(df, F.col("id") % 100 == 0)
    whole = lambda x, y: sum(int(a) * int(b) for a, b in zip(np.floor(x * 1024), np.floor(y * 1024)))
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == brute(rows, 100, 10, whole, True)
    huge = [(0, [1e30, 1.0]), (1, [1e30, 1.0]), (2, [-1e30, 1.0]), (3, [0.5, 0.25])]
    scores = exact_topk.exact_top_k(spark.createDataFrame(huge, VECTORS), F.col("id") == 0).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in scores][0::2] == [(1, 2**63 - 1), (2, -(2**63))]
    assert exact_topk.exact_top_k(spark.createDataFrame([], VECTORS), F.lit(True)).count() == 0


def test_queries_are_read_once_however_many_blocks_there_are(spark, monkeypatch):
    monkeypatch.setattr(vectors, "QUERY_BLOCK", 3)
    rows = [(k, [float(k), 1.0]) for k in range(40)]
    seen = spark.sparkContext.accumulator(0)

    def reading(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    asked = spark.createDataFrame(rows, "id long, v array<double>").mapInArrow(reading, "id long, v array<double>")
    blocks = []

    def search(held):
        blocks.append(sorted(i for ids, _ in held.values() for i in ids.tolist()))
        own = [(i, i, 1) for i in blocks[-1]]
        return spark.createDataFrame(own, "query_id long, vec_id long, score long")

    found = vectors.search_in_blocks(asked, 5, search, "long")
    assert sorted(r.query_id for r in found.collect()) == list(range(40)) == sorted(sum(blocks, []))
    assert len(blocks) == 14 and seen.value == 40


def test_survivors_are_computed_without_the_whole_product():
    """Few pairs pass the finest level; those that score high enough all do."""
    rng = np.random.default_rng(3)
    x = np.floor(1024 * np.cumsum(rng.normal(size=(600, 64)), axis=1) / 8)
    block = exact_topk.QueryBlock(np.arange(20), x[:20], 10)
    block.look(np.arange(100, 300), x[100:300])
    norms = np.linalg.norm(x[300:], axis=1)
    rows, cols = block._survivors(x[300:], norms)
    good = np.argwhere(x[:20] @ x[300:].T >= block.scores[:, -1:])
    assert {(a, b) for a, b in good.tolist()} <= set(zip(rows.tolist(), cols.tolist()))
    assert len(rows) < 0.2 * 20 * 300


def test_segment_statistics_bound_inner_products():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(50, 37)), rng.normal(size=(60, 37))
    exact, before = a @ b.T, None
    for n in (1, 4, 16, 37):
        bound = exact_topk.segment_statistics(a, n) @ exact_topk.segment_statistics(b, n).T
        assert (bound >= exact - 1e-9).all() and (before is None or bound.sum() < before)
        before = bound.sum()


def test_vantage_search_is_exact_at_factor_one(spark, monkeypatch):
    monkeypatch.setattr(vantage, "SHARD", 300)
    monkeypatch.setattr(vantage, "LEAF", 8)
    monkeypatch.setattr(vectors, "QUERY_BLOCK", 12)
    rows = vector_rows()
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    want = brute(rows, 20, 20, lambda x, y: float(sum(float(a) * float(b) for a, b in zip(x, y))), False)
    got = sorted(map(tuple, vantage.nearest(df, F.col("id") % 20 == 0, factor=1.0).select("query_id", "rank", "vec_id", "score").collect()))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want])
    near = vantage.nearest(df, F.col("id") % 20 == 0).collect()
    found = {(r.query_id, r.vec_id) for r in near}
    assert len(found & {(q, i) for q, _, i, _ in want}) / len(want) >= 0.9
    assert vantage.nearest(spark.createDataFrame([], VECTORS), F.lit(True)).count() == 0


def test_recall_of_the_registered_search(spark):
    """Against brute force, with the query's own parameters."""
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    own = usable([(r.vec_id, r.embedding) for r in df.collect()], False)
    ids, x = np.array([k for k, _ in own]), np.stack([v for _, v in own])
    hits = total = 0
    found = {}
    for r in queries.QUERIES["op6_vantage_points"](spark, SF).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    for q, v in own:
        if q % 20 == 0:
            best = [i for i in ids[np.argsort(-(x @ v), kind="stable")] if i != q][:20]
            hits, total = hits + len(found[q] & set(best)), total + len(best)
    assert hits / total >= 0.9


def test_trees_keep_every_row():
    x = np.repeat(np.random.default_rng(0).normal(size=(40, 5)), 30, axis=0)
    order, nodes, bounds = vantage.build_tree(x)
    assert sorted(order) == list(range(len(x)))
    leaves = nodes[nodes[:, 1] < 0]
    assert (leaves[:, 4] - leaves[:, 3]).sum() == len(x) and (leaves[:, 4] - leaves[:, 3]).max() <= vantage.LEAF


# Preferences

TURNS = "pair_id long, side string, turn long, role string, text string"


def test_preferences(spark):
    said = [(1, "chosen", 0, "user", "hi"), (1, "chosen", 1, "assistant", "yes"), (1, "chosen", 2, "user", "so?"), (1, "chosen", 3, "assistant", "well"),
            (1, "rejected", 0, "user", "hi"), (1, "rejected", 1, "assistant", "yes"), (1, "rejected", 2, "user", "so?"), (1, "rejected", 3, "assistant", "né"),
            (2, "chosen", 0, "user", "a"), (2, "rejected", 0, "user", "a"), (3, "chosen", 0, None, None), (4, "rejected", 5, "assistant", "x" * 50_000),
            (5, "chosen", 0, "user", "a"), (5, "chosen", 0, "user", "a"), (5, "rejected", 0, "user", "a"), (None, "chosen", 0, "user", "a"), (6, None, 0, "user", "a")]
    df = spark.createDataFrame(said, TURNS).withColumn("prompt", F.lit("clash")).repartition(3)
    out = {r.pair_id: r for r in preferences.format_preferences(df).collect()}
    assert sorted(out) == [1, 2, 3, 4, 5]
    one = out[1]
    assert one.n_prompt_turns == 3
    assert one.prompt == "<|user|>\nhi<|end|>\n<|assistant|>\nyes<|end|>\n<|user|>\nso?<|end|>\n"
    for text, spans, said_ in ((one.chosen, one.chosen_spans, "well"), (one.rejected, one.rejected_spans, "né")):
        assert [text[s.start : s.end] for s in spans] == [said_ + "<|end|>"]
    assert (out[2].n_prompt_turns, out[2].chosen, out[2].rejected, out[2].chosen_spans) == (1, "", "", [])
    assert (out[3].n_prompt_turns, out[3].chosen) == (0, "<||>\n<|end|>\n")
    assert out[4].chosen == "" and out[4].rejected_spans[0].end == len(out[4].rejected) - 1
    assert (out[5].n_prompt_turns, out[5].chosen, out[5].rejected) == (1, "<|user|>\na<|end|>\n", "")
    assert preferences.format_preferences(spark.createDataFrame([], TURNS)).count() == 0


def test_no_role_need_be_trained(spark):
    turns = spark.createDataFrame([(1, "chosen", 0, "user", "a"), (1, "chosen", 1, "assistant", "b"), (1, "rejected", 0, "user", "c")], TURNS)
    row = preferences.format_preferences(turns, trained=()).first()
    assert row["chosen_spans"] == row["rejected_spans"] == [] and row["chosen"]


def test_mismatched_replies(spark):
    said = [(0, 0, "user", "a"), (0, 1, "assistant", "b"), (0, 2, "user", "c"), (1, 0, "user", "d"), (1, 1, "assistant", "e"),
            (2, 0, "user", "f"), (2, 1, "assistant", None), (4, 0, "user", "g"), (None, 0, "user", "h"), (5, None, "user", "i")]
    df = spark.createDataFrame(said, "conv_id long, turn long, role string, text string").withColumn("side", F.lit(1))
    out = {r.pair_id: r for r in preferences.format_preferences(preferences.mismatched_replies(df)).collect()}
    assert sorted(out) == [0, 1, 2]
    assert {k: r.n_prompt_turns for k, r in out.items()} == {0: 1, 1: 1, 2: 1}
    reply = lambda t: f"<|assistant|>\n{t}<|end|>\n"
    assert [(out[k].chosen, out[k].rejected) for k in (0, 1, 2)] == [
        (reply("b"), reply("e")), (reply("e"), reply("b")), (reply(""), "")]


# WARC


def page_rows():
    rng = random.Random(7)
    htmls = [f"<p>{rng.random()}</p>\r\n\r\né" for _ in range(20)]
    rows = [(k, f"http://x/{k} \r\ny", htmls[k % 20] if k % 3 else "same for a third") for k in range(120)]
    return rows + [(500, None, None), (501, "u", ""), (502, "u", "z" * 300_000), (None, "u", "without id"), (None, "u", htmls[0]), (3, "again", "same for a third")]


def expected(rows):
    first = {}
    for k, _, html in rows:
        if k is not None:
            first[html or ""] = min(k, first.get(html or "", k))
    out = []
    for k, _, html in rows:
        data = (html or "").encode()
        refers = first[html or ""] if k is not None and first[html or ""] != k else None
        out.append((k, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if refers is not None else "response", refers))
    return sorted(out, key=str)


def test_warc_round_trip(spark):
    rows = page_rows()
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("refers_to", F.lit("clash")).repartition(4)
    out = warc.archive_pages(pages).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out), key=str) == expected(rows)
    htmls = {k: h for k, _, h in rows}
    assert all(r.payload.decode() == (htmls[r.page_id] or "") for r in out if r.record_type == "response" and r.page_id is not None)
    assert {r.target_uri for r in out if r.page_id == 1} == {"http://x/1%20%0D%0Ay"}
    few = warc.archive_pages(pages, min_bytes=17, keep_payload=False)
    assert few.filter("payload_bytes < 17 and record_type = 'revisit'").count() == 0 and "payload" not in few.columns
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_normalised_archives_have_one_member_per_record(spark):
    pages = spark.createDataFrame(page_rows(), "page_id long, url string, html string")
    folder = storage.qualified(spark, storage.new_folder(spark, "warc-test"))
    whole = warc.write_archives(warc.with_revisits(pages, "page_id", "html"), folder, size=20_000)
    parts = warc.normalise_archives(whole, folder)
    assert whole.agg(F.sum("records")).first()[0] == parts.agg(F.sum("records")).first()[0] == len(page_rows())
    assert whole.count() > 1
    for row in parts.collect():
        fs, path = pafs.FileSystem.from_uri(row.archive)
        data = fs.open_input_stream(path, compression=None).read()
        index = [line.split("\t") for line in fs.open_input_stream(f"{path}.idx", compression=None).read().decode().splitlines()]
        ends = [int(offset) + int(length) for offset, length, *_ in index]
        assert [int(x[0]) for x in index] == [0, *ends[:-1]] and ends[-1] == len(data)
        for offset, length, kind, name in index:
            record = gzip.decompress(data[int(offset) : int(offset) + int(length)])
            assert record.startswith(b"WARC/1.1\r\n") and f"WARC-Type: {kind}\r\nWARC-Record-ID: {name}".encode() in record


def test_folders_are_qualified(spark):
    for given in ("/tmp/x", "file:/tmp/x", "file:///tmp/x"):
        assert storage.qualified(spark, given) == "file:///tmp/x"


def test_broken_archives_are_noticed():
    good = warc.record(1, "u", b"abc", None)
    assert [warc.parse(r)["payload"] for r in warc.split_records(iter([good[:10], good[10:] + good]))] == [b"abc", b"abc"]
    with pytest.raises(ValueError):
        list(warc.split_records(iter([good[:-1]])))
    with pytest.raises(ValueError):
        warc.parse(good.replace(b"abc", b"abd"))


# Queries and pipeline


def test_queries_are_registered(spark):
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_their_sql(spark, name):
    from checks.compare import compare, connect

    ok, message = compare(spark, connect(SF), SF, name)
    assert ok, message


def test_pipeline_stages(spark):
    """Each stage's decisions against a plain version over its own input."""
    documents = spark.read.parquet(f"{SF}/documents.parquet").withColumn("extra", F.lit(1))
    docs, before = documents, None
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, storage.saved(stage(spark, docs, SF), "stage")
        if name != "packing":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
        was = {r.doc_id: r.text for r in before.collect()}
        now = {r.doc_id: getattr(r, "text", None) for r in docs.collect()}
        assert set(now) <= set(was)
        if name == "quality":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            good = [k for k in was if labels.get(k) == 1]
            assert sum(k in now for k in good) / len(good) > 0.98 and len(now) < len(was)
        if name == "line_dedup":
            assert all(set((now[k] or "").split("\n")) <= set((was[k] or "").split("\n")) for k in now)
        if name == "near_dedup":
            from test_text_operators import brute_components

            want = brute_components(list(was.items()), 5, 80)
            assert set(now) == {k for k, (_, c) in want.items() if k == c}
        if name == "secret_scan":
            from test_text_operators import base_secrets

            assert set(now) == set(was) and not any(base_secrets(t or "") for t in now.values())
            assert all(now[k] == was[k] for k in now if not base_secrets(was[k] or ""))
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def staged(spark, stage, rows):
    """Rows of (doc_id, text) that a stage leaves."""
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.withColumns({"lang": F.lit("en"), "source": F.lit("web"), "n_chars": F.length("text").cast("long")})
    return sorted(((r.doc_id, r.text) for r in stage(spark, docs, SF).collect()), key=lambda r: (r[0] is None, r[0], str(r[1])))


def spelled(k):
    return "q" + "".join("abcdefghij"[int(c)] for c in str(k))


@pytest.mark.parametrize("n", [200, 5000])
def test_pipeline_drops_a_template_with_word_fields_at_any_size(spark, n):
    """Of two word fields each value comes to stand in three documents and more, most pairs of values in one."""
    rng = random.Random(n)
    rows = [(k, f"this page was kept by {spelled(rng.randrange(500))} who lives near {spelled(rng.randrange(500))} since last winter") for k in range(n)]
    # In the same leaf, a smaller template and a line of its own.
    rows += [(n + k, f"this page was made for all of us by the club of {spelled(k)}") for k in range(20)]
    rows += [(n + 50, "this page was never seen in any of the other places before today")]
    assert [k for k, _ in staged(spark, corpus_pipeline.line_dedup, rows)] == [0, n, n + 50]


def test_pipeline_drops_a_long_line_from_two_documents_on(spark):
    line = lambda n, k=7: " ".join([*map(spelled, range(n - 1)), f"{k}th"])
    own = [f"own {spelled(k)} body" for k in range(9)]
    rows = [(1, f"{own[1]}\n{line(20)}"), (2, f"{line(20, 8)}\n{own[2]}"), (3, f"{own[3]}\n{line(19)}"), (4, f"{line(19, 8)}\n{own[4]}"),
            # Twice in one document only, and two forms of one template in two documents.
            (5, f"{line(30)}\n{own[5]}\n{line(30)}"), (6, f"{line(40)} {own[6]}"), (7, f"{line(40)} {own[7]}")]
    want = [(k, own[2] if k == 2 else t) for k, t in rows]
    assert staged(spark, corpus_pipeline.line_dedup, rows) == want
    # In three documents, by its template or by itself: it stays in the first.
    rows = [(k, f"{own[k]}\n{line(25, k)}") for k in (5, 3, 4)] + [(8, f"{line(26)} {own[0]}"), (6, f"{line(26)} {own[1]}"), (7, f"{line(26)} {own[0]}")]
    assert staged(spark, corpus_pipeline.line_dedup, rows) == [(3, rows[1][1]), (4, own[4]), (5, own[5]), (6, rows[4][1])]


def test_pipeline_near_dedup_tells_texts_of_one_id_apart(spark):
    a, b = (" ".join(spelled(k + n) for k in range(40)) for n in (0, 500))
    rows = [(3, a), (5, a), (5, b), (6, None), (6, ""), (None, a)]
    want = [(3, a), (5, b), (6, None), (6, ""), (None, a)]
    assert sorted(staged(spark, corpus_pipeline.near_dedup, rows), key=str) == sorted(want, key=str)
