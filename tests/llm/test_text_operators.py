"""Text operators against brute force, and their edge cases."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from planledger.llm import line_templates, minmax, packing, quality, secret_scan, sentencepieces
from planledger.llm.automaton import compile_rules
from planledger.llm.components import connected_components
from planledger.llm.textbytes import BLOCK, LOWER, span_hashes, word_spans

TOKENIZERS = pytest.importorskip("public_tokenizers")
LONG = "word1 " * 30_000
EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (None, "one two three"), (6, LONG)]
SCHEMA = "doc_id long, text string"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def rows_by(df, key="doc_id"):
    return sorted((r.asDict(recursive=True) for r in df.collect()), key=lambda r: (r[key] is None, r[key] or 0))


# Spans and hashes


def test_span_hashes_depend_on_the_bytes_only():
    texts = [b"ab cd  ab\n", b"", b"cd", b"x" * (BLOCK + 7) + b" ab " + b"y" * 9 + b" cd"]
    buf = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    starts, ends = word_spans(buf, offsets)
    words = [w for t in texts for w in t.split()]
    assert [buf[a:b].tobytes() for a, b in zip(starts, ends)] == words
    seen = {}
    for word, h in zip(words, span_hashes(buf, starts, ends).tolist()):
        assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(set(words))
    assert bytes(LOWER[np.frombuffer("AZé[".encode(), np.uint8)]).decode() == "azé["


def test_span_cache_gives_every_span_its_ids(monkeypatch):
    """With few slots, little room and small slices, which change no result."""
    from planledger.llm import spancache

    monkeypatch.setattr(spancache, "SPANS", 50)
    encode = lambda spans: (np.array([b for s in spans for b in s], np.int32), np.array([len(s) for s in spans], np.int32))
    cache = spancache.SpanCache(encode, bits=3, room=64)
    rng = random.Random(3)
    for _ in range(20):
        text = " ".join("".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(130)).encode()
        buf = np.frombuffer(text, np.uint8)
        starts, ends = word_spans(buf, np.array([0, len(text)]))
        ids, counts = cache.ids(buf, starts, ends)
        assert bytes(ids.tolist()) == text.replace(b" ", b"") and counts.tolist() == (ends - starts).tolist()


def mirrored(n):
    """Two words of n letters that polynomial hashes modulo powers of two take for one."""
    signs = np.array([bin(k).count("1") & 1 for k in range(n)], np.uint8)
    return [((signs ^ flip) + 0x61).tobytes().decode() for flip in (0, 1)]


@pytest.mark.parametrize("n", [1024, 4096, 65536])
def test_mirrored_words_are_told_apart(spark, tiny, n):
    """In one task and in eight, as the span cache sees both words or one of them."""
    one, other = mirrored(n)
    buf = np.frombuffer(f"{one} {other}".encode(), np.uint8)
    assert len(set(span_hashes(buf, *word_spans(buf, np.array([0, len(buf)]))).tolist())) == 2
    rows = [(k, (one, other)[k % 2]) for k in range(8)]
    path = TOKENIZERS.path("word_bpe_49k.json")
    found = []
    for parts in (1, 8):
        docs = frame(spark, rows).repartition(parts)
        both = sentencepieces.decode_ids(sentencepieces.encode_text(docs, tiny[1]), tiny[1])
        assert all(r.text == r.decoded for r in both.collect())
        pieces = packing.tokenize_pieces(docs, path).orderBy("doc_id", "start").collect()
        found.append([tuple(r) for r in pieces])
    assert found[0] == found[1]
    near = rows_by(minmax.near_duplicates(frame(spark, rows).coalesce(1), n=3, percent=85), "doc")
    assert [r["component"] for r in near] == [0, 1] * 4
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    for key, text in rows[:2]:
        ids = [i for r in found[0] if r[0] == key for i in r[-1]]
        assert ids == [*library.encode(text, add_special_tokens=False).ids, 2]


def test_span_cache_survives_colliding_hashes(monkeypatch):
    from planledger.llm import spancache

    monkeypatch.setattr(spancache, "span_hashes", lambda buf, starts, ends, words: np.full(len(starts), 77, np.uint64))
    encode = lambda spans: (np.array([b for s in spans for b in s], np.int32), np.array([len(s) for s in spans], np.int32))
    cache = spancache.SpanCache(encode, bits=3, room=64)
    for text in (b"aa bb aa c", b"bb bb", b"dd aa"):
        buf = np.frombuffer(text, np.uint8)
        ids, counts = cache.ids(buf, *word_spans(buf, np.array([0, len(text)])))
        assert bytes(ids.tolist()) == text.replace(b" ", b"") and counts.tolist() == [len(w) for w in text.split()]


# SentencePiece


@pytest.fixture(scope="module")
def tiny():
    texts = ["▁", "▁a", "a", "b", "ab", "abc", "▁ab", "c", "▁▁", "é"]
    pieces = {t: (260 + k, -1.0 - 0.7 * ((k * 5) % 7)) for k, t in enumerate(texts)}
    return pieces, sentencepieces.build_pieces(pieces, list(range(3, 259)), 260 + len(texts))


def best_ways(text, pieces, unknown):
    """All best segmentations' score, by trying every piece at every place."""
    best = [0.0] + [-np.inf] * len(text)
    for i in range(len(text)):
        for j in range(i + 1, len(text) + 1):
            score = pieces[text[i:j]][1] if text[i:j] in pieces else unknown if j == i + 1 else -np.inf
            best[j] = max(best[j], best[i] + score)
    return best[-1]


def test_viterbi_finds_the_best_way(tiny):
    pieces, model = tiny
    by_id = {i: (t, s) for t, (i, s) in pieces.items()}
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab c é漢\n") for _ in range(rng.randint(0, 14))) for _ in range(400)]
    for text, ids in zip(texts, encoded(model, texts)):
        marked = "▁" + text.replace(" ", "▁") if text else ""
        score, spelled, run = 0.0, "", b""
        for i in ids:
            if i in by_id:
                spelled, score = spelled + run.decode(), score + by_id[i][1]
                score += model.unknown * len(run.decode())
                spelled, run = spelled + by_id[i][0], b""
            else:
                run += bytes([i - 3])
        spelled, score = spelled + run.decode(), score + model.unknown * len(run.decode())
        assert spelled == marked
        assert score == pytest.approx(best_ways(marked, pieces, model.unknown))
        assert model.decode(np.array(ids)) == text


def encoded(model, texts):
    return [x.tolist() for ids, stops in model.encode(pa.array(texts, pa.string())) for x in np.split(ids, stops[:-1])]


def test_encoding_matches_the_library_in_unigram_mode(tmp_path):
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    import sentencepiece

    model = proto.ModelProto()
    model.ParseFromString(open(TOKENIZERS.path("piece_bpe_32k.model"), "rb").read())
    model.trainer_spec.model_type = 1
    for piece in model.pieces:  # the library sums in 32 bits; scores of -1e9 would drown the others
        piece.score = max(piece.score, -50_000)
    path = tmp_path / "unigram.model"
    path.write_bytes(model.SerializeToString())
    own, library = sentencepieces.load_pieces(str(path)), sentencepiece.SentencePieceProcessor(model_file=str(path))
    rng = random.Random(5)
    bits = ["the", "ing", " ", "  ", "\n", "é", "漢", "😀", "a", "Th", ",", "▁", "\t", "xxxxxx", "1", "2024"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(600)]
    assert encoded(own, texts) == library.encode(texts)


def test_sentencepiece_edges(spark, tiny):
    docs = frame(spark, EDGES).withColumn("ids", F.lit("clash")).withColumn("decoded", F.lit(1))
    both = sentencepieces.decode_ids(sentencepieces.encode_text(docs, tiny[1]), tiny[1])
    for row in rows_by(both):
        assert row["decoded"] == (row["text"] or "")
    assert both.columns == ["doc_id", "text", "ids", "decoded"]
    nothing = frame(spark, [])
    assert sentencepieces.decode_ids(sentencepieces.encode_text(nothing, tiny[1]), tiny[1]).count() == 0
    bad = spark.createDataFrame([([3 + 0xFF, 3 + 0x41],), (None,)], "ids array<int>")
    assert [r.decoded for r in sentencepieces.decode_ids(bad, tiny[1]).collect()] == ["�A", None]


# Line dedup


def test_line_dedup_drops_recurring_templates(spark):
    body = [f"{w} {w}x {w}y unlike {w}z" for w in ("aa", "bb", "cc", "dd", "ee")]
    rows = [(k, f"Page {k} of 99 in print\n{body[k]}\nseen by visitor {n} on this very site today") for k, n in enumerate(("ann", "bob", "cyd", "dan", "eve"))]
    out = rows_by(line_templates.dedup_lines(frame(spark, rows), min_docs=3))
    assert [r["n_dropped"] for r in out] == [0, 2, 2, 2, 2]
    assert out[0]["text"] == rows[0][1]
    assert [r["text"] for r in out[1:]] == body[1:]
    strict = rows_by(line_templates.dedup_lines(frame(spark, rows), min_docs=6))
    assert [r["text"] for r in strict] == [t for _, t in rows]


@pytest.mark.parametrize("n", [200, 5000])
def test_line_dedup_drops_a_template_with_word_fields_at_any_size(spark, n):
    """By the query's own defaults, and by its SQL: all but the first of a line form with two fields of 500 words."""
    import duckdb

    rng = random.Random(n)
    spelled = lambda k: "q" + "".join("abcdefghij"[int(c)] for c in str(k))
    rows = [(k, f"this page was kept by {spelled(rng.randrange(500))} who lives near {spelled(rng.randrange(500))} since last winter") for k in range(n)]
    rows += [(n + k, f"{' '.join(spelled(j) for j in range(20 + k // 2))}\nown {spelled(k)} body") for k in range(4)]
    out = rows_by(line_templates.dedup_lines(frame(spark, rows)))
    assert sum(r["n_dropped"] for r in out[:n]) == n - 1
    assert [r["n_dropped"] for r in out[n:]] == [0, 1, 0, 1]  # long lines go from two documents on
    con = duckdb.connect()
    documents = pa.table({"doc_id": [k for k, _ in rows], "text": [t for _, t in rows]})  # noqa: F841
    con.execute("CREATE TABLE documents AS SELECT * FROM documents")
    same = con.execute(line_templates.LINE_DEDUP_SQL).fetchall()
    assert sorted((k, d) for k, _, d, _ in same) == [(r["doc_id"], r["n_dropped"]) for r in out]


def test_line_dedup_edges(spark):
    docs = frame(spark, EDGES + [(7, LONG), (8, LONG), (9, "a b c d\n\na b c d"), (10, "a b c d"), (11, "x\na b c d\n")])
    docs = docs.withColumns({"n_lines": F.lit("clash"), "leaf": F.lit(1), "line": F.lit("extra")})
    out = rows_by(line_templates.dedup_lines(docs))
    found = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in out}
    assert len(out) == 13 and out[0]["line"] == "extra"
    assert found[1] == (0, 0, None) and found[2] == (1, 0, "") and found[None] == (1, 0, "one two three")
    assert found[6][1] == 0 and found[7] == (1, 1, "") and found[8] == (1, 1, "")
    assert found[9] == (3, 0, "a b c d\n\na b c d") and found[10] == (1, 1, "") and found[11] == (3, 1, "x\n")
    assert line_templates.dedup_lines(frame(spark, [])).count() == 0


# Near-duplicates


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)] if words else [])


def brute_components(rows, n, percent):
    sets = {k: shingles(t, n) for k, t in rows}
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), root(k)) for k in ids}


def near_corpus(rng, bases=6, copies=45, words=60):
    """Copies of base texts with so many edits that about half of the pairs are similar enough."""
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    texts = [[word() for _ in range(words)] for _ in range(bases)]
    rows = []
    for k in range(copies * bases):
        own = list(texts[k % bases])
        if k % 7 == 0:  # a copy that later ones copy in turn
            texts[k % bases] = own
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(len(own))] = word()
        rows.append((k, " ".join(own)))
    return rows


@pytest.mark.parametrize("n,percent", [(3, 85), (5, 80)])
def test_near_duplicates_match_brute_force(spark, monkeypatch, n, percent):
    rows = near_corpus(random.Random(n))
    rng = random.Random(1)
    rows += [(1000 + k, rows[k][1].upper()) for k in range(30)] + [(2000 + k, " ".join(rng.choice("xyz") for _ in range(k % 5))) for k in range(30)]
    want = brute_components(rows, n, percent)
    for small in (minmax.SMALL_BUCKET, 0):  # also all through the steep bands
        monkeypatch.setattr(minmax, "SMALL_BUCKET", small)
        got = rows_by(minmax.near_duplicates(frame(spark, rows), n=n, percent=percent), "doc")
        assert {r["doc"]: (r["n_shingles"], r["component"]) for r in got} == want
        assert all(r["kept"] == (r["doc"] == r["component"]) for r in got)


def templated(n, sections=20, variants=3):
    """Documents of sections in a few variants each: all share much, but only every twentieth is
    similar enough to another one, from which it differs in a section."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijk") for _ in range(6))
    parts = [[" ".join(word() for _ in range(12)) for _ in range(variants)] for _ in range(sections)]
    own = []
    for k in range(n):
        own.append([rng.choice(p) for p in parts])
        if k % 20 == 19:
            own[k] = list(own[k - rng.randint(1, 19)])
            own[k][rng.randrange(sections)] = " ".join(word() for _ in range(12))
    return [(k, " ".join(o)) for k, o in enumerate(own)]


def test_families_of_templates_do_not_meet_in_all_pairs(spark, monkeypatch):
    """Of 1,600 documents far fewer than a twentieth of the 436,000 pairs that share a band; all links found."""
    plain, met = minmax._pairs_within, {}
    for n in (400, 1600):
        seen = []
        monkeypatch.setattr(minmax, "_pairs_within", lambda *a, seen=seen: (seen.append(pairs := plain(*a).distinct()), pairs)[1])
        rows = templated(n)
        got = rows_by(minmax.near_duplicates(frame(spark, rows), n=3, percent=85), "doc")
        met[n] = sum(p.count() for p in seen)
        if n == 400:
            assert {r["doc"]: (r["n_shingles"], r["component"]) for r in got} == brute_components(rows, 3, 85)
        assert sum(not r["kept"] for r in got) >= n // 20
    print(met)
    assert met[1600] <= 436_000 / 20 and met[1600] <= 16 * met[400] + 1000, met


def test_steep_bands_and_signatures_miss_next_to_nothing():
    assert minmax.steep_shape(85) == (44, 4) and minmax.steep_shape(80) == (76, 4)
    assert minmax.steep_shape(50)[1] == 1 and minmax.steep_shape(100) == (1, 4)
    rng = np.random.default_rng(12)
    base = rng.integers(0, 1 << 62, 400, dtype=np.uint64)
    for percent in (85, 80):
        bands, permutations = minmax.steep_shape(percent)
        other = round(400 * 2 * percent / (100 + percent))  # elements in common at this similarity
        agree = missed = 0
        for _ in range(150):
            two = [np.sort(x) for x in (base, np.concatenate([base[:other], rng.integers(0, 1 << 62, 400 - other, dtype=np.uint64)]))]
            keys, signs = minmax.steep_keys(two, bands, permutations), minmax.set_signatures(two).view(np.uint32)
            missed += not (keys[0] == keys[1]).any()
            agree += (signs[0] == signs[1]).sum() >= minmax.least_agreement(percent)
            base = rng.permutation(base)
        assert missed == 0 and agree == 150


def test_near_duplicate_edges(spark):
    docs = frame(spark, EDGES + [(7, LONG)]).withColumn("key", F.lit(1)).withColumn("component", F.lit("x"))
    got = rows_by(minmax.near_duplicates(docs), "doc")
    found = [(r["doc"], r["n_shingles"], r["component"], r["kept"]) for r in got]
    assert found == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (5, 1, 4, False),
                     (6, 1, 6, True), (7, 1, 6, False), (None, 1, None, True)]
    assert minmax.near_duplicates(frame(spark, [])).count() == 0


def test_signature_values_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(3)
    hits = total = 0
    for _ in range(60):
        common, a, b = (rng.integers(0, 1 << 63, k, dtype=np.uint64) for k in (170, 15, 15))
        keys = minmax.band_keys([np.concatenate([common, a]), np.concatenate([common, b])])
        hits, total = hits + int((keys[0] == keys[1]).sum()), total + minmax.BANDS
    assert hits / total == pytest.approx(0.85**4, abs=0.05)


def test_components_of_chains_stars_and_loops(spark):
    chain = [(k, k + 1) for k in range(100, 140)]
    random.Random(2).shuffle(chain)
    edges = chain + [(0, k) for k in range(1, 40)] + [(50, 50), (61, 60), (None, 3)]
    labels = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert labels == {k: 100 for k in range(100, 141)} | {k: 0 for k in range(40)} | {50: 50, 60: 60, 61: 60}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# Packing


def test_packing_places_every_id_once(spark):
    from tokenizers import Tokenizer

    path = TOKENIZERS.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    rng = random.Random(8)
    bits = ["it's", "'s", "foo", "FOO", "É", "été,", "!!", "$$$ ", "<|endoftext|>", "<|", "12", " ", "\n", "́", "ẞ", "漢字", "😀", "×"]
    rows = EDGES + [(100 + k, "".join(rng.choice(bits) for _ in range(rng.randint(0, 60)))) for k in range(300)]
    docs = frame(spark, rows).withColumns({"offset": F.lit("clash"), "start": F.lit(1)})
    size = 64
    packed = packing.pack_documents(docs, path, size=size).cache()
    assert packed.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "sequence_id", "offset"]
    pieces = rows_by(packed)
    want = Counter()
    for key, text in rows:
        want[key] += len(tokenizer.encode(text or "", add_special_tokens=False).ids) + 1
    assert Counter({k: sum(p["length"] for p in pieces if p["doc_id"] == k) for k in want}) == want
    texts = dict(rows)
    for p in pieces:
        ids = tokenizer.encode(texts[p["doc_id"]] or "", add_special_tokens=False).ids + [2]
        own = ids[p["start"] : p["start"] + p["length"]]
        assert p["ids"] == own and p["doc_tokens"] == len(ids)
        assert p["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes())
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for spots in by_sequence.values():
        spots.sort()
        assert [o for o, _ in spots] == [sum(n for _, n in spots[:k]) for k in range(len(spots))]
        assert sum(n for _, n in spots) <= size
    filled = sum(p["length"] for p in pieces)
    assert filled / (size * len(by_sequence)) > 0.95
    whole = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    assert all(len(whole[s]) == sum(n for _, n in spots) for s, spots in by_sequence.items())
    assert packing.pack_documents(frame(spark, []), path).count() == 0


def test_shortest_pack_first_is_bounded_by_the_lengths():
    rng = random.Random(6)
    small = {k: rng.randint(0, 9) for k in range(1, 257)}
    large = {k: n * 10**9 for k, n in small.items()}
    steps = packing.shortest_pack_first(large, 256)
    assert len(steps) < 40 * 256
    assert Counter({k: n for k, n in large.items() if n}) == sum((Counter({s[0]: s[2] - s[1]}) for s in steps), Counter())


# Quality


def test_quality_learns_and_is_calibrated(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    rows, labels = [], []
    for k in range(600):
        words = [word() for _ in range(40)]
        good = k % 3 != 0
        rows.append((k, " ".join(words) + "." if good else " ".join(w.upper() + "!!" for w in words)))
        labels.append((k, int(good)))
    labels += [(0, 1), (1, None), (2, 7), (99_999, 1), (None, 1)]
    docs, marks = frame(spark, rows), frame(spark, labels, "doc_id long, quality int")
    model = quality.fit(docs, marks, usable=~quality.held_out())
    scored = rows_by(quality.score_quality(docs.withColumn("held", quality.held_out()).withColumn("score", F.lit("x")), model))
    held = [r for r in scored if r["held"]]
    assert len(held) == sum(zlib.crc32(str(k).encode()) % 3 == 1 for k in range(600))
    assert sum((r["score"] >= 0.5) == (r["doc_id"] % 3 != 0) for r in held) / len(held) > 0.97
    edges = rows_by(quality.score_quality(frame(spark, EDGES), model))
    assert len(edges) == len(EDGES) and all(0 <= r["score"] <= 1 for r in edges)
    assert len({r["score"] for r in edges if not (r["text"] or "").strip()}) == 1
    # Labels of one kind, no labels, no documents.
    only = quality.fit(docs, marks.filter("quality = 1"), usable=F.lit(True))
    assert only.network is None and 0.9 < only.prior < 1
    none = quality.fit(frame(spark, []), marks.limit(0), usable=F.lit(True))
    assert rows_by(quality.score_quality(docs, none))[0]["score"] == 0.5
    assert quality.score_quality(frame(spark, []), none).count() == 0


def plain_features(texts):
    """Word vectors and features one unit at a time, as the module's docstring says."""
    bucket_of, lists = {}, []
    for text in texts:
        found = re.findall(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^A-Za-z0-9\x80-\xff\x20\x09-\x0d]+", (text or "").encode())
        for unit in found:
            one = np.frombuffer(unit, np.uint8)
            bucket_of[unit] = int(span_hashes(one, np.array([0]), np.array([len(one)]))[0] >> np.uint64(51))
        lists.append([(unit, bucket_of[unit]) for unit in found])
    table = np.zeros((quality.BUCKETS, quality.WIDTH))
    for found in lists:
        for (_, one), (_, two) in zip(found, found[1:]):
            for own, other in ((one, two), (two, one)):
                for spot, sign in zip(quality._SPOTS[other], quality._SIGNS[other]):
                    table[own, spot] += sign
    table = np.sign(table) * np.sqrt(np.abs(table))
    table = (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)).astype(np.float32)
    rows = np.zeros((len(texts), quality.N_FEATURES))
    for k, (text, found) in enumerate(zip(texts, lists)):
        if not found:
            continue
        own = np.array([table[b] for _, b in found], np.float64)
        raw = text.encode()
        marks = sum(not re.match(rb"[A-Za-z0-9\x80-\xff]", unit) for unit, _ in found)
        again = sum(a == b for (_, a), (_, b) in zip(found, found[1:]))
        shares = [len(re.findall(rb"[A-Z]", raw)) / len(raw), marks / len(found), again / len(found), np.log1p(len(found)) / 10]
        rows[k] = [*own.mean(axis=0), *np.sqrt(np.maximum((own**2).mean(axis=0) - own.mean(axis=0) ** 2, 0)), *shares]
    return table, rows


def test_word_vectors_and_features_match_a_plain_version(spark):
    rng = random.Random(31)
    bits = ["word", "Ünï", "A", "12", "!?", "...", " ", "  ", "\n", "x1y", "語", "the", "the", "of"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 60))) for _ in range(120)] + [None, "", " \n", "a"]
    table, rows = plain_features(texts)
    got = quality.word_vectors(frame(spark, list(enumerate(texts))).repartition(3))
    assert np.allclose(got, table, atol=1e-6)
    assert np.allclose(quality.features(pa.array(texts), got), rows, atol=1e-4)


def test_the_model_does_not_depend_on_which_of_repeated_ids_comes_first(spark):
    rng = random.Random(32)
    good, bad = ("clean words of a calm page here", "zz zz !! buy NOW 99 !!")
    rows = [(k % 40, " ".join(rng.choice((good, bad)[k % 2].split()) for _ in range(20))) for k in range(240)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int")
    scores = []
    for order in (rows, rows[::-1]):
        model = quality.fit(frame(spark, order).repartition(3), labels, F.lit(True), max_train=30)
        scores.append(model.scores(quality.features(pa.array([t for _, t in rows]), model.table)))
    assert np.array_equal(*scores)


def test_word_vectors_do_not_depend_on_partitioning(spark):
    docs = frame(spark, [(k, f"a{k} b c. d{k % 3}") for k in range(50)])
    assert (quality.word_vectors(docs.repartition(1)) == quality.word_vectors(docs.repartition(7))).all()


# Secrets


def base_secrets(text):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


def test_secrets_match_the_plain_patterns():
    rng = random.Random(1)
    bits = ["password", "PASSWD", "secret", "Token", "api_key", "apikey", '"', "'", " ", ":", "=", "abcdef0123456789", "AKIA", "AKIAAKIA",
            "ABCDEFGH12345678", "deadbeef", "x", "é", "\n", ",", "aB3+/_.-=", "s", "to", "pass", "\x00", "😀", "ſecret"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    texts += ["token=secret:abcdefghijklmnopq", "a" * 9000 + "token" + " " * 9000 + "= abcdefghijklmnop", "f" * 200_000]
    got = secret_scan.find_secrets(pa.array(texts))
    assert [[s for s in spans if s[0] in ("assign", "access", "hex")] for spans in got] == [base_secrets(t) for t in texts]
    assert sum(map(len, got)) > 1000


def test_secret_edges_and_redaction(spark):
    key = "AKIA" + "Q" * 16
    docs = frame(spark, EDGES + [(7, f"é {key} and token = {'a1' * 10} end"), (8, key)]).withColumn("spans", F.lit(1))
    spans = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in rows_by(secret_scan.scan_secrets(docs))}
    assert spans[1] == spans[2] == spans[6] == [] and spans[8] == [("access", 0, 20)]
    assert spans[7] == [("access", 2, 22), ("assign", 27, 55), ("hex", 35, 55)]
    clean = {r["doc_id"]: r["text"] for r in rows_by(secret_scan.redact_secrets(docs.drop("spans")))}
    assert clean[7] == "é [SECRET] and [SECRET] end" and clean[8] == "[SECRET]" and clean[1] is None and clean[6] == LONG
    assert secret_scan.scan_secrets(frame(spark, [])).count() == 0


def test_lanes_may_be_cut_anywhere():
    """The same stretches from lanes without reset bytes, also inside long matches."""
    machine, _ = secret_scan._compiled(secret_scan.RULES)
    rng = random.Random(21)
    bits = ["secret=", "token:", "AKIA", "abcdef0123456789", "AZ09", "ghp_", "xoxb-", "-", "zz", "=", "password", "0", "f" * 40]
    for _ in range(30):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 200))) + rng.choice(["", " ", "\n x secret = abcabcabcabcabc"])
        buf = np.frombuffer(text.encode(), np.uint8)
        whole = machine.match_ends(buf, lane=1 << 20)
        for lane in (1, 7, 64, 100):
            assert all((a == b).all() for one, two in zip(whole, machine.match_ends(buf, lane)) for a, b in zip(one, two))


@pytest.mark.parametrize("unbroken", ["0123456789abcdef", "secret=Ab1", "ghp_0aB-"])
def test_unbroken_text_is_scanned_about_as_fast_as_prose(unbroken):
    """16 MB without a byte that resets the automaton, at no less than a tenth of the speed of prose."""
    size = 16 << 20
    prose = "the quick brown fox jumps over the lazy dog and the other way round; "
    times = []
    for part in (prose, unbroken):
        texts = pa.array([(part * (size // len(part) + 1))[:size]], pa.large_string())
        started = time.perf_counter()
        found = secret_scan.find_secrets(texts)
        times.append(time.perf_counter() - started)
    if unbroken[0] != "g":
        assert found[0]
    assert times[1] <= 10 * times[0], times


def test_automaton_is_minimal_and_rejects_open_ends():
    machine = compile_rules([("a[bc]+", False), ("(x|y){2,}", True)])
    assert len(machine.table) == 5
    (on, off), (on2, off2) = machine.match_ends(np.frombuffer(b"zabcb abab Xyx.xxY", np.uint8), lane=4)
    assert list(zip(on, off)) == [(2, 5), (7, 8), (9, 10)] and list(zip(on2, off2)) == [(12, 14), (16, 18)]
    with pytest.raises(ValueError):
        compile_rules([("ab(cd)?", False)])


def test_digest_columns(spark):
    from planledger.llm.queries import _joined

    found = secret_scan.scan_secrets(frame(spark, [(1, "f" * 16), (2, "no")])).select("doc_id", F.sha2(_joined(F.col("spans")), 256).alias("d"))
    assert [r["d"] for r in rows_by(found)] == [hashlib.sha256(x).hexdigest() for x in (b"hex:0:16", b"")]
