"""Document operators on hand-made rows: nulls, empty and long texts, ties, repeated rows, extra
columns with the names of results, and empty tables."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import brute
from folkmeter.llm import (
    bpe,
    common,
    components,
    decontaminate,
    fingerprints,
    near_duplicates,
    packed,
    quality,
    sharding,
    suffix_dedup,
    token_counts,
    toxicity,
)

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PATTERN = public_tokenizers.PATTERN

RANDOM = random.Random(3)
SYLLABLES = "the an on er in ti es or th st é ñ日 ing nd".split()


def prose(n):
    return " ".join(
        "".join(RANDOM.choice(SYLLABLES) for _ in range(RANDOM.randint(1, 4))) for _ in range(n)
    )


BASE = prose(120)
PASSAGE = prose(60)
ROWS = [
    (1, BASE),
    (2, BASE),
    (3, BASE.replace("the", "THE", 1) + " added"),
    (4, None),
    (5, ""),
    (6, "!!! ???"),
    (7, "!!! ???"),
    (8, "one two"),
    (9, "One, two!"),
    (10, prose(80) + " " + PASSAGE + "\n" + prose(30)),
    (11, prose(10) + "\t" + PASSAGE + " " + prose(90)),
    (12, "ab" * 400),
    (13, prose(8000)),
    (14, "x y z " * 150),
    (15, "é" * 300),
    (16, "é" * 201),
    (17, PASSAGE),
    (18, "<|endoftext|> İ!! 日本 \r\n\x85 \x1c ▁x  y\n\n"),
]
ITEMS = [(1, PASSAGE), (2, "one two"), (3, None), (4, ""), (5, "?!"), (6, " ".join(PASSAGE.split()[:9])), (1, "x Y z")]


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(ROWS, "doc_id bigint, text string").repartition(3)
    return frame.withColumn("lang", F.lit("en")).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string")


def by_id(frame):
    rows = frame.collect()
    assert len(rows) == len({r["doc_id"] for r in rows})
    return {r["doc_id"]: r for r in rows}


# 1 ------------------------------------------------------------------------------------------


@pytest.mark.parametrize("parts", ["1", "8"])
def test_repeats_equal_brute_force(spark, docs, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        found = by_id(suffix_dedup.report(docs.withColumn("n_bytes", F.lit("clash"))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    want = brute.removal_report(ROWS)
    got = {i: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for i, r in found.items()}
    assert got == want
    assert want[17][1] == want[17][0] - 0 or want[17][1] > 0


def test_repeats_of_random_pieces(spark):
    pieces = ["".join(RANDOM.choice("abcdé \n") for _ in range(RANDOM.randint(20, 260))) for _ in range(10)]
    rows = [(i, "".join(RANDOM.choice(pieces) for _ in range(RANDOM.randint(0, 8)))) for i in range(150)]
    found = by_id(suffix_dedup.report(spark.createDataFrame(rows, "doc_id bigint, text string")))
    want = brute.removal_report(rows)
    assert {i: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for i, r in found.items()} == want


def test_texts_without_repeats(docs):
    out = suffix_dedup.clean(docs)
    assert out.columns == docs.columns
    want = brute.without_repeats(ROWS)
    got = {i: r.text for i, r in by_id(out).items()}
    assert got[4] is None
    assert {i: t or "" for i, t in got.items()} == want


def test_repeated_rows_are_one_document(spark):
    rows = [(1, BASE), (1, BASE), (2, BASE), (None, PASSAGE * 3)]
    out = suffix_dedup.report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    removed = sorted((r.doc_id or 0, r.n_removed) for r in out)
    assert [r for r in removed if r[0] == 1] == [(1, 0), (1, 0)]
    assert (2, len(BASE.encode())) in removed


def test_one_text_longer_than_a_segment(monkeypatch):
    data = np.frombuffer((BASE + PASSAGE + BASE).encode() * 3, np.uint8)
    ends = np.array([0, len(data)])
    whole = suffix_dedup.fragments(data, ends[:-1], ends[1:] - suffix_dedup.WINDOW + 1)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 700)
    cut = [
        (a + base, b + base, p + base)
        for piece, base, low, high, _ in suffix_dedup._segments(data, ends)
        for a, b, p, _ in zip(*suffix_dedup.fragments(piece, low, high))
    ]
    places = {w: p for a, b, p in cut for w in range(a, b + 1)}
    assert places == {w: p for a, b, p, _ in zip(*whole) for w in range(a, b + 1)}


def test_deep_shallow_order():
    rows = [bytes(RANDOM.choice(b"ab") for _ in range(RANDOM.choice([3, 30, 60]))) for _ in range(300)]
    rows += rows[:50] + [b"a" * 50 + bytes([i]) for i in b"zyx"]
    group = np.array([i % 3 for i in range(len(rows))])
    matrix = np.zeros((len(rows), 60), np.uint8)
    for i, r in enumerate(rows):
        matrix[i, : len(r)] = list(r)
    length = np.array([len(r) for r in rows])
    order, common_ = suffix_dedup.deep_shallow(matrix, length, group)
    padded = [(group[i], matrix[i].tobytes()) for i in order]
    assert padded == sorted(padded)
    for k in range(1, len(order)):
        a, b = rows[order[k - 1]], rows[order[k]]
        same = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
        assert common_[k] == (same if group[order[k]] == group[order[k - 1]] else -1)


# 2 ------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    import tiktoken

    with open(MULTI, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(docs, library):
    found = by_id(bpe.round_trip(docs.withColumn("n_tokens", F.lit(0)), MULTI, PATTERN, ids="ids"))
    for doc_id, text in ROWS:
        ids = library.encode_ordinary(text or "")
        row = found[doc_id]
        assert row.ids == ids and row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    back = bpe.decode(bpe.encode(docs, MULTI, PATTERN), MULTI, PATTERN)
    assert {i: bytes(r.decoded).decode() for i, r in by_id(back).items()} == {i: t or "" for i, t in ROWS}


def test_bpe_on_random_strings(library):
    tool = bpe.codec(MULTI, PATTERN)
    bits = ["a", "e", "é", " ", "  ", "\n", "the", "'s", "12", "!!", "　", "\x1c", "\x85", "́", "日", "😀", "aaaa", "\xa0"]
    for _ in range(3000):
        text = "".join(RANDOM.choice(bits) for _ in range(RANDOM.randint(0, 30)))
        assert tool.encode(text).tolist() == library.encode_ordinary(text)


def test_pairs_stay_apart_as_the_merges_say():
    tool = bpe.codec(MULTI, PATTERN)
    made = [r for r in range(300, 20_000, 7) if tool.merged(tool.tokens[r]) == [r]]
    for _ in range(20_000):
        a, b = RANDOM.choice(made), RANDOM.choice(made)
        assert tool.apart(a, b) == (tool.merged(tool.tokens[a] + tool.tokens[b]) == [a, b])


# 3 ------------------------------------------------------------------------------------------


def test_counts_and_cache(spark, docs):
    import sentencepiece

    tool = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    cache = common.new_folder(spark, "counts")
    found = by_id(token_counts.count(docs.withColumn("n_bytes", F.lit("x")), PIECES, cache))
    for doc_id, text in ROWS:
        n = len(tool.encode(text or ""))
        assert tuple(found[doc_id])[-3:] == (len((text or "").encode()), n, n > 4096)
    stored = spark.read.parquet(cache).count()
    assert stored == len({(t or "").replace(" ", "▁") for _, t in ROWS})
    again = docs.unionByName(docs.limit(0)).union(docs.sparkSession.createDataFrame([(99, "quite new", "en")]))
    token_counts.count(again, PIECES, cache)
    assert spark.read.parquet(cache).count() == stored + 1


# 4 and 6 ------------------------------------------------------------------------------------


def _auc(score, label):
    order = np.argsort(np.argsort(score))
    n1 = int(label.sum())
    return (order[label == 1].sum() - n1 * (n1 - 1) / 2) / (n1 * (len(label) - n1))


@pytest.fixture(scope="module")
def larger(spark):
    folder = "/root/testdata/sf0.1"
    read = spark.read.parquet
    return read(f"{folder}/documents.parquet").select("doc_id", "text"), read(f"{folder}/labels.parquet")


def test_quality_on_held_out_rows(larger):
    docs, labels = larger
    found = common.stored(quality.features(docs))
    model = quality.fit(found, labels)
    rows = quality.score(found, model).join(labels, "doc_id").toPandas()
    held = rows[[zlib.crc32(str(i).encode()) % 3 == 1 for i in rows.doc_id]]
    assert _auc(held.score.values, held.quality.values) > 0.99
    assert ((held.score >= 0.5) == (held.predicted == 1)).all()
    assert held.score.between(0, 1).all() and np.all(np.diff(model.steps) >= 0)


def test_toxicity_on_held_out_rows(larger):
    docs, labels = larger
    model = toxicity.fit(docs, labels)
    assert (np.diff(model.thresholds) > 0).all()
    rows = toxicity.score(docs, model).join(labels.withColumnRenamed("toxic", "label"), "doc_id").toPandas()
    held = rows[[zlib.crc32(str(i).encode()) % 3 == 1 for i in rows.doc_id]]
    assert _auc(held.expected_severity.values, held.label.values) > 0.95
    assert held.toxic[held.label == 1].mean() > 0.85 and held.toxic[held.label == 0].mean() < 0.03


def test_scores_without_labels(spark, docs, empty):
    none = spark.createDataFrame([(1, None, None)], "doc_id bigint, quality int, toxic int")
    found = quality.features(docs)
    assert {r.score for r in quality.score(found, quality.fit(found, none)).collect()} == {0.5}
    flags = toxicity.score(docs.withColumn("toxic", F.lit(1)), toxicity.fit(docs, none)).collect()
    assert len(flags) == len(ROWS) and not any(r.toxic for r in flags)
    assert quality.features(empty).count() == 0 and toxicity.score(empty, toxicity.NOTHING).count() == 0
    assert set(quality.keep_good(docs, quality.fit(found, none)).columns) == set(docs.columns)


def test_pooled_is_monotone():
    places, values = quality.pooled(np.arange(6.0), np.ones(6), np.array([0, 1, 0, 1, 1, 0.0]))
    assert np.all(np.diff(values) > 0)
    assert abs(values[0]) < 1e-9 and abs(values[-1] - 2 / 3) < 1e-9 and len(places) == 3


# 5 ------------------------------------------------------------------------------------------


@pytest.mark.parametrize("block_words", [10, 100_000])
def test_benchmark_hits(spark, docs, block_words):
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    found = by_id(decontaminate.find(docs.withColumn("n_hit", F.lit("x")), bench, block_words=block_words))
    for doc_id, text in ROWS:
        n, hit, names = brute.benchmark_hits(text, ITEMS)
        row = found[doc_id]
        assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (n, len(hit), len(names), bool(hit))
        assert row.items_sha256 == hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()


def test_benchmark_passages_are_cut(spark, docs, empty):
    bench = spark.createDataFrame([(1, PASSAGE)], "item_id bigint, text string")
    out = decontaminate.clean(docs.withColumn("n_words", F.lit("mine")), bench)
    rows = by_id(out)
    assert out.columns == [*docs.columns, "n_words"]
    assert 17 not in rows and rows[1].text == BASE and rows[4].text is None and rows[1].n_words == "mine"
    assert PASSAGE not in rows[10].text and rows[10].text.replace("  \n", "") != ""
    assert not brute.benchmark_hits(rows[10].text, [(1, PASSAGE)])[1]
    assert decontaminate.clean(empty, bench).count() == 0
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.clean(docs, none).count() == len(ROWS)


def test_automaton_longest_matches():
    words = [RANDOM.randint(0, 3) for _ in range(60)]
    other = [RANDOM.randint(0, 3) for _ in range(200)]
    tool = decontaminate.SuffixAutomaton([words[:30], words[30:]], 6, ["a", "b"])
    factors = {tuple(s[i:j]) for s in (words[:30], words[30:]) for i in range(30) for j in range(i + 1, 31)}
    state = matched = 0
    for k, word in enumerate(other):
        state, matched = tool.step(state, matched, word)
        want = max(n for n in range(0, k + 2) if n == 0 or tuple(other[k + 1 - n : k + 1]) in factors)
        assert matched == want


# 7 ------------------------------------------------------------------------------------------


def test_packed_ids(spark, docs, empty):
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(WORDS)
    folder = common.new_folder(spark, "ids")
    manifest = packed.write(docs, WORDS, 2, folder, length=64)
    found = by_id(packed.read_documents(manifest, folder))
    start, all_ids = 0, []
    for doc_id, text in ROWS:
        ids = [*tool.encode(text or "", add_special_tokens=False).ids, 2]
        row = found[doc_id]
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
        all_ids.append(ids)
    for part in manifest.orderBy("part").collect():
        shard = packed.Shard(folder, part["name"])
        stream = np.concatenate([shard.sequence(i)[0][shard.sequence(i)[1]] for i in range(-(-part.n_tokens // 64))])
        assert len(stream) == part.n_tokens
        for row in shard.index.to_pylist():
            ids = np.concatenate([*shard.pieces(row["start"], row["n_tokens"])])
            assert ids.tolist() == all_ids[row["doc_id"] - 1]
            assert stream[row["start"] : row["start"] + row["n_tokens"]].tolist() == ids.tolist()
    folder = common.new_folder(spark, "ids")
    assert packed.read_documents(packed.write(empty, WORDS, 2, folder), folder).count() == 0


def test_word_encoder_on_random_strings():
    tool = packed.WordEncoder(WORDS)
    bits = ["a", "B", "é", " ", "\n", "the", "'s", "12", "!!", "İ", "Σ", "　", "\x1c", "́", "日", "<|endoftext|>", "The,", "\xa0"]
    for _ in range(3000):
        text = "".join(RANDOM.choice(bits) for _ in range(RANDOM.randint(0, 25)))
        ids = np.frombuffer(tool.encode([text])[0], tool.kind).tolist()
        assert ids == tool.tool.encode(text, add_special_tokens=False).ids


def test_latin_words_go_to_the_merges_at_once():
    """Without the normaliser and the splitter of the library, and with its ids."""
    tool = packed.WordEncoder(WORDS)
    library, sent = tool.tool, []

    class Spy:
        model = library.model

        def encode_batch_fast(self, words, **rest):
            sent.extend(words)
            return library.encode_batch_fast(words, **rest)

    tool.tool = Spy()
    letters = [chr(c) for c in range(0x41, 0x180) if chr(c).isalpha()]
    words = [a + b for a in letters for b in letters[::7]] + ["Größe,", "àé", "İl", "ſo", "ŉa", "a×b"]
    want = [found.ids for found in library.encode_batch_fast(words, add_special_tokens=False)]
    assert [np.frombuffer(c, tool.kind).tolist() for c in tool.encode(words)] == want
    assert not {"Größe", "größe", "àé"} & {*sent} and "İl" in sent


# 8 ------------------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [2, 3, 4])
def test_curve_visits_neighbours(n):
    import itertools

    digits, states = sharding.curve_tables(n)
    place = {}
    for cells in itertools.product(range(8), repeat=n):
        state = index = 0
        for bit in (2, 1, 0):
            cell = sum(((c >> bit) & 1) << i for i, c in enumerate(cells))
            at = state * (1 << n) + cell
            index, state = index * (1 << n) + digits[at], states[at]
        place[index] = cells
    assert sorted(place) == list(range(8**n))
    steps = (sum(abs(a - b) for a, b in zip(place[i], place[i + 1])) for i in range(8**n - 1))
    assert set(steps) == {1}


def test_shards(spark, empty):
    rows = [(i if i % 7 else None, "x" * (i % 50) if i % 5 else None, ["en", "fr", None][i % 3]) for i in range(500)]
    frame = spark.createDataFrame(rows + rows[:40], "doc_id bigint, text string, lang string").withColumn("shard", F.lit("x"))
    frame = frame.withColumns({"size": sharding.text_size(), "c": sharding.text_crc32()}).drop("text")
    dims = {"size": F.col("size"), "lang": sharding.string_rank("lang")}
    out = sharding.assign(frame, dims, ["doc_id", "c"]).collect()
    assert len(out) == 540
    counts = {}
    for r in out:
        counts.setdefault(r.shard, []).append(r.slot)
    assert set(counts) == set(range(16)) and max(map(len, counts.values())) - min(map(len, counts.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in counts.values())
    ordered = [r["curve"] for r in sorted(out, key=lambda r: (r.shard, r.slot))]
    assert ordered == sorted(ordered)
    none = empty.withColumn("size", sharding.text_size()).drop("text")
    assert sharding.assign(none, {"size": F.col("size")}, ["doc_id"]).count() == 0


def test_ranks_follow_whole_strings(spark):
    names = [f"https://site-{i:02d}.example/é" for i in range(40)] + [None, "", "z"]
    frame = spark.createDataFrame([(i, n) for i, n in enumerate(names * 2)], "doc_id bigint, source string")
    rows = sharding.with_ranks(frame, {"rank": "source"}).collect()
    ranks = {(r.source or "").encode(): r["rank"] for r in rows}
    assert len(rows) == 86 and all(r["rank"] == ranks[(r.source or "").encode()] for r in rows)
    in_order = [ranks[n] for n in sorted(ranks)]
    assert in_order == sorted(set(in_order))


# 9 ------------------------------------------------------------------------------------------


def test_classes_equal_brute_force(spark):
    rows = list(ROWS) + [(20 + i, BASE + " " + prose(1 + i)) for i in range(12)] + [(1, BASE), (40, "")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("node", F.lit("clash"))
    found = sorted((r.doc_id, r.class_id) for r in near_duplicates.classes(frame)[0].collect())
    assert found == sorted(zip((i for i, _ in rows), brute.near_classes(rows)))


def near_family(size=2000, planted=40, words=400):
    """Texts of about 0.75, and planted pairs of a little more than 0.8, with their similarities."""
    draw = np.random.default_rng(5)
    texts, hit = [], np.zeros((size, words - 4), np.float32)
    for i in range(size):
        places = draw.choice(words, 6, replace=False).tolist()
        kind = [i] * 6
        if i >= size - planted:  # like the text ``planted`` rows before, but for some words
            places, kind = list(family_places[i - planted]), [i - planted] * 6
            places += [p for p in draw.permutation(words).tolist() if p not in places][:7]
            kind += [i] * 7
        elif i == 0:
            family_places = []
        family_places.append(places)
        text = [f"w{k}" for k in range(words)]
        for p, k in zip(places, kind):
            text[p] = f"x{k}y{p}"
            hit[i, max(p - 4, 0) : p + 1] = 1
        texts.append((i, " ".join(text)))
    n = hit.sum(axis=1)
    shared = words - 4 - (n[:, None] + n[None, :] - hit @ hit.T)
    similarity = shared / (2 * (words - 4) - shared)
    for i in range(size - planted, size):
        value = brute.similarity(brute.bag(texts[i][1]), brute.bag(texts[i - planted][1]))
        similarity[i, i - planted] = similarity[i - planted, i] = value
    np.fill_diagonal(similarity, 1)
    return texts, similarity


def test_no_pair_of_a_large_family_is_missed(spark, monkeypatch):
    """Most buckets hold hundreds of nodes that are not alike; the planted pairs are all found."""
    texts, similarity = near_family()
    assert 0.7 < np.median(similarity[:1900, :1900]) < 0.79
    least = np.arange(len(texts))
    while True:
        after = np.array([least[row >= 0.8 - 1e-9].min() for row in similarity])
        if (after == least).all():
            break
        least = after
    monkeypatch.setattr(near_duplicates, "CHUNK", 300)  # buckets of several blocks
    frame = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(8)
    found = {r.doc_id: r.class_id for r in near_duplicates.classes(frame)[0].collect()}
    assert sum(similarity[i, i - 40] >= 0.8 for i in range(1960, 2000)) >= 30
    assert [found[i] for i in range(len(texts))] == least.tolist()


def test_one_of_each_class_stays(spark, docs, empty):
    twice = docs.unionAll(docs)
    kept = near_duplicates.keep_one(twice)
    want = set(brute.near_classes(ROWS))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(want)
    assert near_duplicates.keep_one(empty).count() == 0
    names = ["node", "_node", "head", "NODE1", "least", "packed"]
    clash = docs.withColumns({n: F.lit(n) for n in names})
    kept = near_duplicates.keep_one(clash)
    assert kept.columns == clash.columns and all(r["_node"] == "_node" and r["head"] == "head" for r in kept.collect())


def test_places_are_cut_by_bytes(spark, monkeypatch):
    """Chunks of a bucket by the bytes of its texts; the classes stay those of brute force."""
    texts, _ = near_family(120, 10, 120)
    monkeypatch.setattr(near_duplicates, "CHUNK_BYTES", 9_000)
    frame = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4)
    found = sorted((r.doc_id, r.class_id) for r in near_duplicates.classes(frame)[0].collect())
    assert found == sorted(zip((i for i, _ in texts), brute.near_classes(texts)))


def test_signatures_estimate_weighted_similarity():
    errors = []
    for _ in range(30):
        w = (BASE + " ") * 2 + "rep " * 60
        other = w.split()
        for _ in range(RANDOM.randint(1, 60)):
            other[RANDOM.randrange(len(other))] = "new"
        texts = [w, " ".join(other)]
        import pyarrow as pa

        block = common.utf8(pa.array(texts))
        a, b = near_duplicates.signatures(near_duplicates.Bags(*block))
        errors.append((a == b).mean() - brute.similarity(brute.bag(texts[0]), brute.bag(texts[1])))
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.07


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (102, 101), (200, 200), (5, 0), (100, 102)]
    rows = components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    want = {i: 0 for i in range(61)} | {100: 100, 101: 100, 102: 100}
    assert {r.node: r.component for r in rows} == want and len(rows) == len(want)


# 10 -----------------------------------------------------------------------------------------


def test_fingerprints(spark, docs, empty):
    import pyarrow as pa

    found = by_id(fingerprints.compare(docs.withColumn("n_chars", F.lit(0))))
    texts = [t or "" for _, t in ROWS]

    def pieces(t):
        p = fingerprints.Pieces(*common.utf8(pa.array([t])))
        return set(p.key.tolist())

    def likeness(a, b):
        a, b = pieces(a), pieces(b)
        return len(a & b) / len(a | b) if a | b else 1.0

    for i, (doc_id, text) in enumerate(ROWS):
        text, after = text or "", texts[(i + 1) % len(texts)]
        n = len(text) // 4
        changed = text[: len(text) - n] + after[:n]
        row = found[doc_id]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert abs(row.near_edited - likeness(text, changed)) < 1e-9
        assert abs(row.near_next - likeness(text, after)) < 1e-9
    assert found[1].fingerprint == found[2].fingerprint and found[4].fingerprint == found[5].fingerprint
    assert fingerprints.compare(empty).count() == 0
    one = fingerprints.compare(docs.filter("doc_id = 1")).first()
    assert one.near_next == 1.0
