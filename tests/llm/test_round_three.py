"""Sharding, fill-in-middle and alignment against brute force, and their edge cases."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from planledger.llm import alignment, balance, infilling
from planledger.llm.perfect_hash import PerfectHash, counted_index

TOKENIZERS = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"
LONG = "word1 wörd " * 9_000
EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (None, "one two three"), (6, LONG), (7, "é 漢 😀"), (8, "a<S>b")]
SCHEMA = "doc_id long, text string"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


# Sharding


def differenced_plainly(sizes, shards):
    """Karmarkar-Karp as it is described: lists of items, sorted anew in each step."""
    parts = [[(0, [])] * (shards - 1) + [(size, [k])] for k, size in enumerate(sizes)]
    while len(parts) > 1:
        parts.sort(key=lambda p: p[0][0] - p[-1][0])
        one, two = parts[0], parts[1]
        both = [(x + y, a + b) for (x, a), (y, b) in zip(one, reversed(two))]
        parts[:2] = [sorted(both, key=lambda x: x[0])]
    return [total for total, _ in parts[0]]


def test_differencing_follows_the_method():
    rng = random.Random(1)
    for _ in range(60):
        shards, sizes = rng.randint(2, 6), rng.sample(range(1, 100_000), rng.randint(1, 25))
        sums, went = balance.differenced([[s] for s in sizes], shards)
        assert sums == differenced_plainly(sizes, shards)
        own = [0] * shards
        for size, (place,) in zip(sizes, went):
            own[place] += size
        assert own == sums


def test_differencing_of_partial_partitions():
    rng = random.Random(2)
    parts = [[rng.randint(0, 500) for _ in range(rng.randint(1, 7))] for _ in range(30)]
    sums, went = balance.differenced(parts, 7)
    own = [0] * 7
    for part, places in zip(parts, went):
        assert len(set(places)) == len(part)  # what was apart stays apart
        for size, place in zip(part, places):
            own[place] += size
    assert own == sums == sorted(sums) and max(sums) - min(sums) < 100
    assert balance.differenced([], 3) == ([0, 0, 0], [])


def shards_of(rows):
    groups, slots, sizes = defaultdict(set), defaultdict(list), Counter()
    for r in rows:
        groups[r["text_hash"], r["size"]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert all(len(s) == 1 for s in groups.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sizes


@pytest.mark.parametrize(("parcel", "few"), [(2048, 64), (8, 4)])
def test_sharding_balances_bytes_and_keeps_groups(spark, monkeypatch, parcel, few):
    """In one parcel, and in parcels on several levels."""
    monkeypatch.setattr(balance, "PARCEL", parcel)
    monkeypatch.setattr(balance, "FEW", few)
    rng = random.Random(3)
    texts = ["x" * int(rng.lognormvariate(5, 1)) + str(k) for k in range(600)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(1000 + k, texts[k % 7]) for k in range(60)]
    out = [r.asDict() for r in balance.shard_documents(frame(spark, rows), 8).collect()]
    sizes = shards_of(out)
    assert len(out) == len(rows) and set(sizes) == set(range(8))
    by_id = dict(rows)
    assert all(r["size"] == len(by_id[r["doc_id"]]) + 16 and r["text_crc32"] == zlib.crc32(by_id[r["doc_id"]].encode()) for r in out)
    assert max(sizes.values()) - min(sizes.values()) <= 0.01 * sum(sizes.values()) / 8


def test_sharding_of_a_group_larger_than_a_shard(spark):
    rows = [(k, "the same text in a third of all rows") for k in range(400)] + [(1000 + k, f"text {k} " * (k % 50 + 1)) for k in range(300)]
    sizes = shards_of([r.asDict() for r in balance.shard_documents(frame(spark, rows), 20).collect()])
    hot, *rest = sorted(sizes.values(), reverse=True)
    assert hot == 400 * (36 + 16) and max(rest) - min(rest) <= 0.02 * max(rest)


def test_sharding_edges(spark, tmp_path):
    docs = frame(spark, EDGES).withColumns({"size": F.lit("clash"), "shard": F.lit(1), "extra": F.lit(2)})
    sharded = balance.shard_documents(docs, 3).cache()
    out = [r.asDict() for r in sharded.collect()]
    shards_of(out)
    assert Counter(r["doc_id"] for r in out) == Counter(k for k, _ in EDGES)
    assert {(r["size"], r["text_crc32"]) for r in out if r["doc_id"] in (1, 2)} == {(16, 0)}
    assert {r["law"] for r in out} == {"bytes"} and {r["grown_shard"] for r in out} == {None}
    assert balance.shard_documents(frame(spark, []), 3).count() == 0
    balance.write_shards(docs, sharded, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards")).collect()
    assert Counter((r["doc_id"], r["text"]) for r in back) == Counter(EDGES)
    assert sorted((r["shard"], r["slot"]) for r in back) == sorted((r["shard"], r["slot"]) for r in out)


# Fill-in-middle


def infilled_plainly(key, text):
    h = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    text = text or ""
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return "plain", None, None, text
    a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    if h4 % 100 < 20:
        return "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


@pytest.mark.parametrize("units", [1, 7, infilling.UNITS])
def test_infilling_is_the_plain_transformation_at_any_frame_size(spark, units):
    rng = random.Random(units)
    rows = EDGES + [(100 + k, "".join(rng.choice("ab <P>SM é漢😀\n") for _ in range(rng.randint(0, 60)))) for k in range(300)]
    rows = [r for r in rows if units > 1 or r[1] != LONG]
    docs = frame(spark, rows).withColumns({"n": F.lit("clash"), "form": F.lit(1), "extra": F.lit("kept")})
    out = infilling.fill_in_middle(infilling.frame_texts(docs, units=units)).collect()
    assert len(out) == len(rows) and {r["extra"] for r in out} == {"kept"}
    text_of = defaultdict(set)
    for key, text in rows:
        text_of[key].add(text or "")
    for r in out:
        whole = infilling.frame_text([tuple(f) for f in r["frames"]])
        (text,) = text_of[r["doc_id"]]
        form, prefix, middle, output = infilled_plainly(r["doc_id"], text)
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], whole) == (len(text), form, prefix, middle, output)
        assert r["output_sha256"] == hashlib.sha256(output.encode()).hexdigest()
        assert r["restored_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [f["first"] for f in r["frames"]] == list(accumulate([0, *(f["units"] for f in r["frames"])]))[:-1]
    assert {r["form"] for r in out} == {"plain", "psm", "spm"}
    assert infilling.fill_in_middle(infilling.frame_texts(frame(spark, []))).count() == 0


def test_selection_reads_only_the_cut_frames(monkeypatch):
    io = infilling.Frames()
    text = "".join(chr(0x61 + k % 26) for k in range(1000))
    frames, read = io.cut(text, 10), []
    monkeypatch.setattr(io, "read", lambda data, own=io.read: read.append(1) or own(data))
    output = infilling.rearranged(frames, "psm", 333, 333, io)
    assert len(read) == 2
    assert infilling.frame_text(output) == f"<P>{text[:333]}<S>{text[666:]}<M>{text[333:666]}"
    assert infilling.frame_text(infilling.restored(output, "psm", io)) == text


def test_marks_are_found_across_frames():
    io = infilling.Frames()
    output = io.cut("<S>tail<P>head<M>mid", 2)
    assert infilling.frame_text(infilling.restored(output, "spm", io)) == "headmidtail"


# Alignment


@pytest.fixture(scope="module")
def paths():
    return TOKENIZERS.path("byte_bpe_50k.json"), TOKENIZERS.path("piece_bpe_32k.model")


def groups_plainly(text, paths, held={}):
    if not held:
        import sentencepiece
        from tokenizers import Tokenizer

        held["a"], held["b"] = Tokenizer.from_file(paths[0]), sentencepiece.SentencePieceProcessor(model_file=paths[1])
        held["a"].encode_special_tokens = True
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        letters = {chr(b): b for b in plain}
        letters |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
        held["letters"] = letters
    if not text:
        return None
    a, b = held["a"].encode(" " + text, add_special_tokens=False), held["b"].encode(text)
    ids_a = a.ids
    spelled_a = [bytes(held["letters"][c] for c in t) for t in a.tokens]
    spelled_b = [bytes([int(p[3:5], 16)]) if held["b"].is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, held["b"].id_to_piece(i)) for i in b)]
    whole = (" " + text).encode()
    if b"".join(spelled_a) != whole or b"".join(spelled_b) != whole:
        return None
    ends_a, ends_b = (np.cumsum([len(x) for x in s]).tolist() for s in (spelled_a, spelled_b))
    place_a, place_b = ({e: k for k, e in enumerate(ends)} for ends in (ends_a, ends_b))
    groups, i, j = [], 0, 0
    for end in ends_a:
        if end in place_b:
            groups.append((ids_a[i : place_a[end] + 1], b[j : place_b[end] + 1]))
            i, j = place_a[end] + 1, place_b[end] + 1
    return groups


def aligned_plainly(rows, paths):
    groups = [groups_plainly(text, paths) for _, text in rows]
    counts = Counter((x[-1], y[-1]) for own in groups if own for x, y in own)
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    for (key, _), own in zip(rows, groups):
        spelled = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in own or [])
        links = [(x[-1], y[-1]) for x, y in own or []]
        yield (
            key, sum(len(x) for x, _ in own or []), sum(len(y) for _, y in own or []), len(links), len(links),
            sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
            hashlib.sha256(spelled.encode()).hexdigest() if own else "", spelled,
        )


def corpus(spark):
    rng = random.Random(6)
    bits = ["the", "ing", " ", "  ", "\n", " \n", "é", "漢", "😀", "a", "Th", ",", "\t", "xxxxxx", "1", "2024", "'s", "'ll ", "▁", "<|endoftext|>", "<s>", "<0x41>", "　", " ", "\x00", "ñ", " о", "Ω"]
    rows = [(200 + k, "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))) for k in range(500)]
    real = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(60).collect()]
    return EDGES + rows + [(10_000 + k, t) for k, t in real]


@pytest.mark.parametrize("slices", [1 << 15, 40])
def test_texts_in_slices_spell_the_same_groups(spark, monkeypatch, paths, slices):
    monkeypatch.setattr(alignment, "SLICE", slices)
    rows = corpus(spark)
    texts, both = pa.array([t for _, t in rows]), alignment.aligner(*paths)
    pairs = [alignment.pair_keys(*part.links()) for *_, parts in both.blocks(texts) for part in parts]
    index = PerfectHash(np.concatenate(pairs))
    found = [b""] * len(rows)
    for first, _, _, parts in both.looking_up(index, np.ones(len(index), np.int64), np.ones(len(index), bool)).blocks(texts):
        for part in parts:
            for k, spelled in part.spelled():
                found[first + k] += bytes(spelled)
    assert [x[1:].decode() for x in found] == [r[-1] for r in aligned_plainly(rows, paths)]


def test_alignment_matches_brute_force(spark, paths):
    """Whole texts by the libraries themselves."""
    rows = corpus(spark)
    docs = frame(spark, rows).withColumns({"n_a": F.lit("clash"), "extra": F.lit("kept")}).repartition(3)
    out = alignment.align_tokenizers(docs, *paths).collect()
    assert {r["extra"] for r in out} == {"kept"}
    found = Counter((r["doc_id"], *(r[name] for name in alignment.RESULT)) for r in out)
    assert found == Counter(aligned_plainly(rows, paths))
    assert any(r["n_a"] == 0 and r["doc_id"] in dict(rows) and "▁" in (dict(rows)[r["doc_id"]] or "") for r in out)


def test_alignment_of_nothing_and_of_unbroken_text(spark, paths):
    assert alignment.align_tokenizers(frame(spark, []), *paths).count() == 0
    unbroken = [(1, "ab1" * 40_000), (2, None), (3, " " * 5_000)]
    out = alignment.align_tokenizers(frame(spark, unbroken), *paths).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in ("doc_id", *alignment.RESULT)) for r in out] == list(aligned_plainly(unbroken, paths))


def test_spans_without_merges_known_take_the_library(paths, monkeypatch):
    """A vocabulary whose merges can't be read as ranks gives the same ids."""
    own = alignment.Aligner(*paths)
    texts = [b" one's two,  three", b" \n x y", b" 12345 \xc3\xa9t\xc3\xa9"]
    expected = own._records(texts)
    own.merge = None
    assert all((x == y).all() for x, y in zip(expected, own._records(texts)))
    ranks = alignment.merge_ranks(paths[0])
    assert len(ranks) == 50_256 and ranks[b"the"] == own.a.token_to_id("the")


def test_linked_tokens_are_suffixes_so_pairs_are_bounded(spark, paths):
    own = alignment.aligner(*paths)
    keys = alignment.link_counts(frame(spark, corpus(spark)), *paths).select("key").distinct().collect()
    for (key,) in keys:
        a, b = own.bytes_a.joined(np.array([key >> 32])), own.bytes_b.joined(np.array([key & 0xFFFFFFFF]))
        assert a.endswith(b) or b.endswith(a)


def test_perfect_hash_is_minimal_and_verified():
    rng = np.random.default_rng(7)
    for n in (0, 1, 2, 1000, 50_000):
        keys = np.unique(rng.integers(-(1 << 62), 1 << 62, n))
        index = PerfectHash(keys)
        assert sorted(index.find(keys).tolist()) == list(range(len(keys)))
        assert (index.find(np.setdiff1d(rng.integers(-(1 << 62), 1 << 62, 500), keys)) == -1).all()


def test_tree_sum_is_the_sum(spark, monkeypatch):
    from planledger.llm import perfect_hash
    from planledger.llm.storage import saved

    monkeypatch.setattr(perfect_hash, "CHUNK", 7)
    monkeypatch.setattr(perfect_hash, "FAN", 2)
    rng = random.Random(8)
    rows = [(rng.randint(0, 60) * 977, rng.randint(1, 9)) for _ in range(900)]
    counts = saved(frame(spark, rows, "key long, n long").repartition(11), "counts")
    index, sums = counted_index(counts)
    plain = Counter()
    for key, n in rows:
        plain[key] += n
    assert dict(zip(index.keys.tolist(), sums.tolist())) == dict(plain)
