"""Operators that compare rows with each other, and the pipeline, against brute force."""

import itertools
import random
import re

import corpus_pipeline
import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as driver
from checks.compare import connect
from labelflow.llm import decontaminate, graph, jaccard, neighbours, packing, queries


def small_docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("clash")).withColumn("h", F.lit(1))


# Jaccard join -----------------------------------------------------------------------------------


def brute_classes(rows):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 75 * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(d)
    return sorted((d, len(s), min(groups[find(i)])) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def near_copies(seed, n, vocabulary=400):
    r = random.Random(seed)
    rows, bases = [], []
    for i in range(n):
        kind = r.random()
        if bases and kind < 0.7:
            words = list(r.choice(bases))
            for _ in range(r.randrange(0, 4)):
                words[r.randrange(len(words))] = f"n{r.randrange(vocabulary)}"
            if r.random() < 0.3:
                words = words[r.randrange(3):]
        else:
            words = [f"w{r.randrange(vocabulary)}" for _ in range(r.choice([1, 3, 5, 6, 7, 8, 10, 14, 30, 60, 90]))]
            bases.append(words)
        rows.append((i, " ".join(words) or "x"))
    return rows


@pytest.mark.parametrize("seed, part, border", [(1, None, None), (2, 3, None), (3, None, 1), (4, 2, 20)])
def test_classes_equal_brute_force(spark, monkeypatch, seed, part, border):
    if part:  # every list is dealt to parts
        monkeypatch.setattr(jaccard.Keys, "of", _in_parts(jaccard.Keys.of, part))
    if border:
        monkeypatch.setattr(jaccard, "border", lambda *_: border)
    rows = near_copies(seed, 250)
    got = sorted(map(tuple, jaccard.classes(small_docs(spark, rows)).collect()))
    assert got == brute_classes(rows)


def _in_parts(of, parts):
    def dealt(self, shingles):
        keys, n, rest = of(self, shingles)
        return keys, n * 0 + parts, rest
    return dealt


def test_prefixes_share_what_they_must():
    r = random.Random(5)
    for _ in range(3000):
        n = r.randrange(1, 60)
        x = r.sample(range(10_000), n)
        y = [e if r.random() > 0.12 else r.randrange(10_000, 20_000) for e in x]
        y = sorted(set(y + r.sample(range(20_000, 30_000), r.randrange(3))))
        x = sorted(x)
        common = len(set(x) & set(y))
        if 100 * common >= 75 * len(set(x) | set(y)):
            assert set(x[:jaccard.prefix(n, 1)]) & set(y[:jaccard.prefix(len(y), 1)])
            if common > 1:
                assert len(set(x[:jaccard.prefix(n, 2)]) & set(y[:jaccard.prefix(len(y), 2)])) > 1


def test_odd_documents(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE two"), (6, "one two three"), (None, "one  two"),
            (7, "a b c d e f " * 3000), (8, "a b c d e f " * 3001), (9, "a b c d e f"), (9, "a b c d e f")]
    got = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard.classes(small_docs(spark, rows)).collect()}
    assert got[1, 0] == 1 and got[2, 0] == 2 and got[3, 0] == 3 and got[6, 1] == 6
    assert got[4, 1] == got[5, 1] == got[None, 1] == 4 and got[7, 6] == got[8, 6] == 7 and got[9, 2] == 9
    assert jaccard.classes(small_docs(spark, rows).limit(0)).count() == 0
    kept = jaccard.one_of_each(small_docs(spark, rows))
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is not None, x))
    assert ids in ([1, 2, 3, 6, 7, 9], [None, 1, 2, 3, 6, 7, 9]) or ids == [1, 2, 3, 4, 6, 7, 9]
    assert kept.columns == ["doc_id", "text", "n", "h"]


def test_jaccard_query_equals_sql(spark):
    want = connect(SMALL).sql(queries.ORACLE["op9_jaccard_join"]).fetchall()
    assert sorted(map(tuple, queries.QUERIES["op9_jaccard_join"](spark, SMALL).collect())) == sorted(want)


def test_rows_of_lists_are_written_for_pairs_without_a_centre_only(spark, monkeypatch):
    r = random.Random(6)
    bases = [[f"w{b}x{i}" for i in range(60)] for b in range(40)]
    rows = [(2 * b + k, " ".join(words[:-k or None])) for b, words in enumerate(bases) for k in range(2)]
    written, lists = [], jaccard._lists
    monkeypatch.setattr(jaccard, "_lists", lambda *a: written.append(lists(*a)) or written[-1])
    assert sorted(map(tuple, jaccard.classes(small_docs(spark, rows)).collect())) == brute_classes(rows)
    assert written[0].filter("b IS NOT NULL").count() and not written[0].filter("b IS NULL").count()
    # Many in a list, half of them similar to few others.
    rows += [(100 + i, " ".join(r.choice(bases[0]) if r.random() < i / 200 else w for w in bases[0])) for i in range(60)]
    assert sorted(map(tuple, jaccard.classes(small_docs(spark, rows)).collect())) == brute_classes(rows)
    assert written[1].filter("b IS NULL").count()


def test_sketches_tell_long_sets_apart():
    r = np.random.default_rng(4)
    for n, m in [(0, 5), (9, 2000), (3000, 4000), (9000, 9000), (40_000, 33_000)]:
        x, y = (r.integers(0, 1 << 63, k).astype(np.uint64) for k in (n, m))
        y[:min(n, m) // 2] = x[:min(n, m) // 2]
        most = jaccard.most_common(jaccard.sketch_of(x), jaccard.sketch_of(y), n, m)
        assert min(n, m) // 2 <= most <= 0.85 * min(n, m) + 5
        assert jaccard.most_common(jaccard.sketch_of(x), jaccard.sketch_of(x), n, n) == n


def test_blocks_of_keys_take_no_more_bytes_for_more_slots(spark):
    r = random.Random(7)
    texts = spark.createDataFrame([(" ".join(f"{r.random()}" for _ in range(100)),) for _ in range(1500)], "text string").coalesce(1)
    size, found = {}, {}
    for slots in (16, 512):
        blocks = jaccard._key_blocks(texts, np.zeros(jaccard.BINS, np.int64), 1, slots).collect()
        size[slots] = sum(len(b.block) for b in blocks) - 64 * len(blocks)
        columns = [(b.slot, jaccard._unpack(b.block)) for b in blocks]
        assert all(0 <= slot < slots for slot, _ in columns)
        found[slots] = sorted(row for _, c in columns for row in zip(*(x.tolist() for x in c)))
        places = [set(c[0].tolist()) for _, c in columns]
        assert sum(map(len, places)) == len(set().union(*places))  # one slot for each place
    assert found[16] == found[512] and size[512] <= size[16]


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (102, 101), (5, 5)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


# Neighbours -------------------------------------------------------------------------------------


def exact(ids, x, q, k):
    score = x @ x[q] / (np.linalg.norm(x, axis=1) * np.linalg.norm(x[q]))
    order = [i for i in np.lexsort((ids, -score)) if ids[i] != ids[q]][:k]
    return [(int(ids[i]), score[i]) for i in order]


@pytest.mark.parametrize("sf_dir", [SMALL, "/root/testdata/sf0.1"])
def test_recall(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=float)
    got = {}
    for r in queries.QUERIES["op6_neighbours"](spark, sf_dir).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    found = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        want = exact(ids, x, q, 5)
        mine = got[int(ids[q])]
        assert sorted(mine) == [1, 2, 3, 4, 5] and [mine[i][1] for i in range(1, 6)] == sorted(
            (s for _, s in mine.values()), reverse=True)
        found += len({v for v, _ in want} & {v for v, _ in mine.values()})
        total += 5
    assert found >= 0.9 * total


def test_vectors_that_take_no_part_ties_and_copies(spark):
    inf = float("inf")
    rows = [(0, [1.0, 0.0, 0.5]), (50, [1.0, 0.0, 0.5]), (7, [1.0, 0.0, 0.5]), (3, [2.0, 0.1, 1.0]), (4, None), (5, [0.0, 0.0, 0.0]),
            (6, [1.0, inf, 0.0]), (8, [1.0, float("nan"), 0.0]), (9, [1.0, None, 0.0]), (10, [1.0]), (11, []),
            (12, [1e200, 0.0, 5e199]), (None, [1.0, 0.0, 0.5]), (7, [1.0, 0.0, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    got = {}
    for r in neighbours.search(df, F.col("vec_id") % 50 == 0, k=5).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.vec_id
    assert set(got) == {0, 50}
    assert sorted(got[0].values()) == [3, 7, 12, 50] and sorted(got[50].values()) == [0, 3, 7, 12]
    assert got[0][4] == got[50][4] == 3  # the others point the same way
    assert neighbours.search(df.limit(0), F.lit(True)).count() == 0


# Packing ----------------------------------------------------------------------------------------


def test_bounds_have_the_least_padding():
    r = random.Random(0)
    for _ in range(300):
        n, k = r.randrange(1, 9), r.randrange(1, 6)
        lengths, counts = sorted(r.sample(range(1, 60), n)), [r.randrange(1, 9) for _ in range(n)]

        def padding(bounds):
            return sum((min(b for b in bounds if b >= x) - x) * c for x, c in zip(lengths, counts))

        bounds = packing.optimal_bounds(np.array(lengths), np.array(counts), k)
        best = min(padding([*cut, lengths[-1]]) for m in range(min(k, n)) for cut in itertools.combinations(lengths[:-1], m))
        assert len(bounds) <= k and padding(bounds) == best


def test_batches_hold_every_row_once_within_the_budget(spark, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK_ROWS", 20)
    monkeypatch.setattr(packing, "CHUNK_BATCHES", 1)
    rows = [(i % 90, "w " * (i % 37)) for i in range(300)] + [(500, None), (None, "a b"), (501, "long " * 5000)]
    docs = small_docs(spark, rows).withColumn("bucket", F.lit("clash"))
    got = packing.pack(docs, buckets=4, token_budget=100).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in got if r.doc_id is not None) == sorted(
        (d, len((t or "").split()) + 1) for d, t in rows if d is not None)
    batches = {}
    for r in got:
        batches.setdefault((r.bucket, r.chunk, r.batch), []).append(r)
        assert r.padding == r.bound - r.n_tokens >= 0
    for members in batches.values():
        assert sorted(r.slot for r in members) == list(range(len(members)))
        assert {r.batch_rows for r in members} == {len(members)}
        assert len(members) == 1 or sum(r.bound for r in members) <= 100
    assert packing.pack(docs.limit(0)).count() == 0


# Decontamination --------------------------------------------------------------------------------

ITEMS = [
    (1, "If Anna has 12 apples and gives 5.5 kg to Peter, how many apples does Anna still have after 3 days of walking to "
        "the old market?"),
    (2, None), (3, "short one"), (4, ""),
    (5, "The quick brown fox jumps over the lazy dog while the other nine foxes sleep near the quiet river bank all night."),
]


def test_copies_and_reparameterised_questions_are_found(spark):
    rows = [
        (1, "Intro. If Maria has 30 apples and gives 7 lbs to Jonas, how many apples does Maria still have after 9 days of "
            "walking to the old market? End."),
        # One person of the item is two here: the slots do not fit.
        (2, "If Maria has 30 apples and gives 30 kg to Jonas, how many apples does Peter still have after 9 days of walking "
            "to the old market?"),
        (3, None), (4, ""), (None, ITEMS[4][1].upper()), (6, "A clean text about nothing that matters to anyone at all here."),
        (7, "x " * 20_000 + ITEMS[4][1] + " y" * 20_000), (7, "clean"), (7, "clean"), (8, "the quick brown fox jumps over"),
    ]
    docs = small_docs(spark, rows).withColumn("item_id", F.lit("clash"))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.contamination(docs, items).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id or 0, r.item_id, r.reparameterised) for r in got if r.contaminated) == [
        (0, 5, False), (1, 1, True), (7, 5, False)]
    kept = decontaminate.without_leaks(docs, items)
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == sorted(
        (d, t or "") for d, t in rows if d not in (None, 1) and len(t or "") < 20_000)
    assert kept.columns == docs.columns
    for a, b in ((docs.limit(0), items), (docs, items.limit(0))):
        assert all(not r.contaminated for r in decontaminate.contamination(a, b).collect())


def test_every_passage_of_the_benchmark_is_found(spark):
    def words(t):
        return "".join(c.lower() if c.isalpha() else " " for c in t or "").split()

    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()
    parts = [" " + " ".join(words(r.text)) + " " for r in items]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    whole = {r.doc_id for r in docs if any(p in " " + " ".join(words(r.text)) + " " for p in parts)}
    got = {r.doc_id for r in queries.QUERIES["op8_decontamination"](spark, SMALL).collect() if r.contaminated}
    assert whole <= got
    eight = {tuple(w[i:i + 8]) for r in items for w in [words(r.text)] for i in range(len(w) - 7)}
    assert got <= {r.doc_id for r in docs for w in [words(r.text)] if any(tuple(w[i:i + 8]) in eight for i in range(len(w) - 7))}


def found_by(spark, items, texts):
    """Ids of the items that contaminate each text."""
    items = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = small_docs(spark, list(enumerate(texts)))
    found = {i: set() for i in range(len(texts))}
    for r in decontaminate.find_leaks(docs, items).collect():
        found[r.doc_id].add(r.item_id)
    return [found[i] for i in range(len(texts))]


def test_one_contradicting_slot_does_not_hide_the_rest(spark):
    r = random.Random(3)
    words = [r.choice("abcdefgh") + str(i).translate(str.maketrans("0123456789", "klmnopqrst")) for i in range(200)]
    words[20] = words[160] = "1990"
    words[100] = "1991"
    altered = [*words[:160], "1991", *words[161:]]
    chance = "the old farmer walks for {} days and then eats {} apples near the river before he comes home again"
    # One name of three places is another in one of them.
    person = "after lunch {} sings a long song and then {} reads a thick old book while {} waits for rain near home"
    items = [" ".join(words), chance.format(2, 2), person.format("Anna", "Anna", "Anna")]
    texts = [" ".join(altered), chance.format(3, 5), person.format("Maria", "Maria", "Peter"),
             person.format("Maria", "Peter", "Jonas")]
    assert found_by(spark, items, texts) == [{0}, {1}, {2}, set()]


def test_copies_in_another_case_or_with_other_white_space_are_found(spark):
    german = "In der Stadt steht ein Haus am Fluss und vor dem Haus liegt der Garten mit einem Baum"
    asked = "If Anna has 12 apples and gives five to Peter how many apples does Anna still have today"
    other = asked.replace("Anna", "Maria").replace("Peter", "Jonas").replace("12", "31")
    spaced = other.replace(" Maria", "\n  Maria").replace(" Jonas", "\u00a0 Jonas")
    texts = [german.lower(), german.upper(), asked.lower(), asked.upper(), spaced, german.title()]
    assert found_by(spark, [german, asked], texts) == [{0}, {0}, {1}, {1}, {1}, {0}]


def test_short_items_rows_of_numbers_and_texts_without_spaces_are_found(spark):
    items = ["What is the capital of France?", "12 + 7 = 19, 4 * 5 = 20, 9 - 2 = 7, 8 / 4 = 2", "法国的首都是哪一座城市?", "Why not?",
             "Who wrote Hamlet?"]
    texts = ["He asked: what is the capital of France? Paris.", "So 12 + 7 = 19, 4 * 5 = 20, 9 - 2 = 7, 8 / 4 = 2 it is",
             "请问法国的首都是哪一座城市?谢谢", "why not", "Well, why not?", "What is the capital of Spain?", "who wrote Hamlet",
             "So 13 + 8 = 21, 5 * 6 = 30, 7 - 1 = 6, 9 / 3 = 3 it is", ""]
    assert found_by(spark, items, texts) == [{0}, {1}, {2}, {3}, set(), set(), {4}, set(), set()]


def test_short_items_are_not_found_in_prose(spark):
    items = ["What is this?", "Who wrote the play Hamlet?", "Wie alt ist der Hund?"]
    texts = ["He came in. What is this? Nobody knew, and so they went home again.", "One.\nWhat is this?\nTwo",
             "Tell me who wrote the play Hamlet and when it was done.", "It is late. Who wrote the play Hamlet? Nobody knows.",
             "He asked: \u201cWho wrote the play Hamlet?\u201d and left.", "1.5 apples, 2.7 pears. Wie alt ist der Hund? 3.5 Jahre.",
             "\u5b57\u5b57\u3002 WIE ALT IST DER HUND!\x05", "So what is this?", "what is this"]
    assert found_by(spark, items, texts) == [set(), {0}, set(), {1}, {1}, {2}, {2}, set(), {0}]


def test_items_without_placeholders_equal_brute_force(spark):
    r = random.Random(11)
    vocabulary = [a + b for a in "bcdfg" for b in ("a", "e", "o", "u")]
    row = lambda n: [r.choice(vocabulary) for _ in range(n)]
    items = [row(r.choice((8, 9, 12, 16, 30, 60))) for _ in range(25)] + [["ba"] * 20]
    docs = [["ba"] * 15, ["ba"] * 40]
    for _ in range(250):
        text = row(r.randrange(60))
        for item in r.sample(items, r.randrange(3)):
            at, a = r.randrange(len(text) + 1), r.randrange(len(item))
            text[at:at] = item[a:a + r.randrange(5, 40)]
        docs.append(text)
    want = []
    for d in docs:
        want.append(set())
        windows = {tuple(d[p:p + 8]) for p in range(len(d) - 7)}
        for i, item in enumerate(items):
            hit = [p for p in range(len(item) - 7) if tuple(item[p:p + 8]) in windows]
            covered = len({p + j for p in hit for j in range(8)})
            if covered >= min(16, max(8, -(-len(item) // 2))):
                want[-1].add(i)
    assert sum(map(bool, want)) > 50
    assert found_by(spark, [" ".join(i) for i in items], [" ".join(d) for d in docs]) == want


# Pipeline ---------------------------------------------------------------------------------------


def test_stages_keep_what_brute_force_keeps(spark):
    from labelflow.llm import pii

    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_duplicates", "decontamination", "personal_data", "packing"]
    rows = [(d, t) for d, t in near_copies(9, 60)] + [(900, "12 34"), (901, None), (902, ""), (903, ITEMS[0][1])]
    rows.append((904, "words with a mail a.b@c.de inside of it, and more"))
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    stage = {name: f for name, f in corpus_pipeline.STAGES}
    known = stage["language_id"](spark, docs, SMALL)
    assert known.columns == docs.columns
    assert {r.doc_id for r in known.collect()} == {d for d, _ in rows} - {900, 901, 902}
    single = stage["near_duplicates"](spark, known, SMALL)
    left = [(r.doc_id, r.text) for r in known.collect()]
    assert {r.doc_id for r in single.collect()} == {c for _, _, c in brute_classes(left)}
    masked = {r.doc_id: r for r in stage["personal_data"](spark, single, SMALL).collect()}
    assert "<EMAIL>" in masked[904].text and masked[904].n_chars == len(masked[904].text)
    assert all(r.text == pii.masked(dict(rows)[d]) for d, r in masked.items())
    assert stage["packing"](spark, single, SMALL).count() == single.count()


def test_pipeline_and_registration(spark):
    assert {f"op{n}" for n in range(1, 14)} | {"pipeline"} == {
        q.split("_")[0] for q in driver.queries() if q.startswith("op") or q == "pipeline"}
    packed = driver.queries()["pipeline"](spark, SMALL).collect()
    classes = {r.component_id for r in queries.QUERIES["op9_jaccard_join"](spark, SMALL).collect()}
    leaks = {r.doc_id for r in queries.QUERIES["op8_decontamination"](spark, SMALL).collect() if r.contaminated}
    assert {r.doc_id for r in packed} <= classes and not {r.doc_id for r in packed} & leaks


# Neighbours in small, opposite and mixed tables ---------------------------------------------------


def exact_neighbours(rows, k):
    out = []
    for q, v in rows:
        mine = [(i, w) for i, w in rows if i != q and len(w) == len(v)]
        cos = sorted((-(float(np.dot(np.array(v), np.array(w))) / (np.linalg.norm(v) * np.linalg.norm(w))), i) for i, w in mine)
        out += [(q, r, i) for r, (_, i) in enumerate(cos[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("case", ["few", "opposite", "two widths", "narrow first"])
def test_every_query_gets_its_neighbours(spark, case):
    r = np.random.default_rng(5)
    rows = {
        "few": [(i, r.normal(size=64)) for i in range(4)],
        "opposite": [(1, np.array([1.0, 0.0, 0.0])), (2, np.array([-1.0, 0.0, 0.0]))],
        "two widths": [(i, r.normal(size=8 if i % 2 else 5)) for i in range(14)],
        "narrow first": [(0, np.array([1.0, 2.0]))] + [(i, r.normal(size=16)) for i in range(1, 8)],
    }[case]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<double>")
    got = sorted((x.query_id, x.rank, x.vec_id) for x in neighbours.search(df, F.lit(True), k=5).collect())
    want = exact_neighbours(rows, 5)
    assert [x[:2] for x in got] == [x[:2] for x in want]  # as many as there are, up to k
    size = {i: len(v) for i, v in rows}
    assert all(size[q] == size[i] and q != i for q, _, i in got)
    if case in ("few", "opposite"):  # no more candidates than asked for: all of them, in exact order
        assert got == want


def test_recall_on_clustered_vectors(spark):
    r = np.random.default_rng(6)
    centres = r.normal(size=(40, 32)) * 2
    rows = [(i, centres[i % 40] + r.normal(size=32) * 0.3) for i in range(2000)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<double>")
    got = {(x.query_id, x.vec_id) for x in neighbours.search(df, F.col("vec_id") % 50 == 0, k=5).collect()}
    unit = np.array([v / np.linalg.norm(v) for _, v in rows])
    best = unit[::50] @ unit.T
    want = {(50 * q, int(i)) for q, row in enumerate(best) for i in [j for j in np.argsort(-row) if j != 50 * q][:5]}
    assert len(got) == 200 and len(got & want) >= 0.9 * len(want)


def test_blocks_of_probes_never_pass_the_driver(spark, monkeypatch):
    # A query becomes a row for each probe, so by the planner's figures its blocks look small enough for a broadcast.
    plans = {}

    def written(df, name="table", write=neighbours.materialize):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(neighbours, "materialize", written)
    r = np.random.default_rng(8)
    df = spark.createDataFrame([(i, r.normal(size=16).tolist()) for i in range(400)], "vec_id long, embedding array<double>")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        assert len({x.query_id for x in neighbours.search(df, F.col("vec_id") % 4 == 0).collect()}) == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    joins = re.findall(r"(\w+Join) \[tab#\d+, bucket#\d+L?\]", plans["ranks"])
    assert joins and set(joins) == {"SortMergeJoin"}


@pytest.mark.parametrize("small", [False, True])
def test_rounding_decides_nothing(spark, monkeypatch, small):
    if small:  # blocks of few vectors, and candidates that are thinned out and handed on again and again
        for name, value in {"BLOCK": 7, "QUERY_BLOCK": 3, "CHUNK": 20, "HELD": 64}.items():
            monkeypatch.setattr(neighbours, name, value)
    # Cosines differ by less than single precision can tell apart; one vector has copies, one has none that is near.
    r = np.random.default_rng(9)
    first = r.normal(size=24)
    rows = [(i, first + r.normal(size=24) * 1e-6) for i in range(300)] + [(300 + i, first.copy()) for i in range(9)]
    rows += [(400, -first), (401, first * 1e200), (402, first * 1e-200)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<double>").repartition(5)
    got = {}
    for x in neighbours.search(df, (F.col("vec_id") % 10 == 0) | (F.col("vec_id") > 305)).collect():
        got.setdefault(x.query_id, {})[x["rank"]] = (x.vec_id, x.score)

    def score(v, w):
        v, w = (np.ldexp(x, -np.frexp(np.abs(x).max())[1]) for x in (v, w))
        return (v * w).sum() / (np.sqrt((v * v).sum()) * np.sqrt((w * w).sum()))

    asked = [(i, v) for i, v in rows if i % 10 == 0 or i > 305]
    assert set(got) == {i for i, _ in asked}
    for q, v in asked:
        want = sorted(((-score(v, w), i) for i, w in rows if i != q))[:5]
        assert [got[q][n] for n in range(1, 6)] == [(i, -s) for s, i in want]
