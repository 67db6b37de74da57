import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from rosterlake.llm import common
from rosterlake.llm import near_duplicates as nd


def bag(text):
    words = text.split()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def similarity(a, b):
    common = sum((a & b).values())
    whole = sum(a.values()) + sum(b.values()) - common
    return common / whole if whole else 0.0


def brute_classes(rows):
    """Connected components of equal texts and similarities of 0.8 or more."""
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    bags = [bag(t or "") for _, t in rows]
    holders = defaultdict(list)
    for i, b in enumerate(bags):
        for j in {j for s in b for j in holders[s]}:
            if similarity(b, bags[j]) >= 0.8:
                parent[root(i)] = root(j)
        for s in b:
            holders[s].append(i)
    first = {}
    for i, (_, text) in enumerate(rows):
        parent[root(i)] = root(first.setdefault(text or "", i))
    groups = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        groups[root(i)].append(doc_id)
    return Counter(tuple(sorted(g, key=str)) for g in groups.values())


def found_classes(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r.class_id].append(r.doc_id)
    return Counter(tuple(sorted(g, key=str)) for g in groups.values())


def test_signatures_estimate_weighted_similarity():
    random.seed(1)
    vocabulary = [f"w{i}" for i in range(200)]
    errors = []
    for trial in range(40):
        one = [random.choice(vocabulary) for _ in range(random.choice([6, 30, 200, 600]))]
        one = one[:6] * random.randint(1, 40) + one if trial % 3 == 0 else one
        two = list(one)
        for _ in range(max(1, len(two) // random.choice([10, 30, 80]))):
            two[random.randrange(len(two))] = f"x{random.random()}"
        two = two + one[:6] * random.randint(1, 20) if trial % 4 == 0 else two
        owner, element, weight = nd.shingles([" ".join(one), " ".join(two)], 5)
        regs = nd.bag_min_hash(owner, element, weight, 2, 1024)
        errors.append((regs[0] == regs[1]).mean() - similarity(bag(" ".join(one)), bag(" ".join(two))))
        sides = [(element[owner == k], weight[owner == k]) for k in (0, 1)]
        sides = [(e[o], w[o]) for (e, w), o in ((s, np.argsort(s[0])) for s in sides)]
        assert nd.overlap(*sides) == similarity(bag(" ".join(one)), bag(" ".join(two)))
    assert abs(np.mean(errors)) < 0.01 and np.abs(errors).max() < 0.08


def test_classes_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = nd.op10_near_duplicates(spark, "/root/testdata/sf0.01").collect()
    assert found_classes(found) == brute_classes([(r.doc_id, r.text) for r in docs.collect()])


def test_chains_and_a_large_group(spark):
    """A chain whose ends are unlike, and many variants of one text that are linked by it alone."""
    random.seed(7)
    base = [f"v{i}" for i in range(120)]
    rows, chain = [], list(base)
    for i in range(9):
        rows.append((i, " ".join(chain)))
        chain = chain[:]
        chain[i * 12] = f"c{i}"
    hub = [f"h{i}" for i in range(150)]
    rows.append((100, " ".join(hub)))
    for i in range(101, 161):
        variant = list(hub)
        for at in random.sample(range(0, 150, 10), 2):
            variant[at] = f"n{i}-{at}"
        rows.append((i, " ".join(variant)))
    rows += [(200 + i, " ".join(random.choice("abcdefgh") + str(random.randrange(10**6)) for _ in range(60))) for i in range(30)]
    random.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = found_classes(nd.classes(spark, docs).collect())
    assert got == brute_classes(rows) and max(map(len, got)) == 61


def test_joins_without_broadcasts(spark, documents, monkeypatch):
    usual = sorted(tuple(r) for r in nd.classes(spark, documents).collect())
    monkeypatch.setattr(common.Budget, "takes", lambda *_: False)
    monkeypatch.setattr(nd, "fits_broadcast", lambda *_: False)
    assert sorted(tuple(r) for r in nd.classes(spark, documents).collect()) == usual


def test_awkward_rows(spark, awkward, nothing):
    found = nd.classes(spark, awkward).collect()
    assert len(found) == awkward.count() and nd.classes(spark, nothing).count() == 0
    class_of = defaultdict(set)
    for r in found:
        class_of[r.doc_id].add(r.class_id)
    assert class_of[1] == class_of[2] == {1}  # null and empty are one text
    assert class_of[6] == {6} and 6 in class_of[7] and class_of[3] == {3}
    stage = nd.stage(spark, awkward, "")
    assert stage.columns == awkward.columns
    assert sorted(r.doc_id for r in stage.select("doc_id").distinct().collect() if r.doc_id) == [1, 3, 4, 5, 6, 7]
    assert nd.stage(spark, nothing, "").count() == 0


def test_pairs_among_texts_that_share_a_passage(spark):
    """Near copies that share their buckets with many unlike texts, all with one long passage."""
    random.seed(11)
    passage = [f"p{i}" for i in range(150)]
    rows = []
    for i in range(300):
        own = passage + [f"t{i}-{k}" for k in range(50)]
        rows.append((2 * i, " ".join(own)))
        if i < 40:
            for at in random.sample(range(5, 195, 10), 4):
                own[at] = f"e{i}-{at}"
            rows.append((2 * i + 1, " ".join(own)))
    alike = [similarity(bag(rows[k][1]), bag(rows[k + 1][1])) for k in range(0, 80, 2)]
    assert 0.80 <= min(alike) and max(alike) <= 0.83
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for params in (nd.NearParams(), nd.NearParams(bands=8, rows=1)):  # the latter: few buckets, nearly all texts in each
        assert found_classes(nd.classes(spark, docs, params).collect()) == brute_classes(rows)


def test_bound_lets_all_alike_pairs_through():
    random.seed(2)
    texts = []
    for n in (1, 6, 60, 70, 126, 130, 600, 5000):
        base = [random.choice("abcdefgh") + str(random.randrange(n)) for _ in range(n)] + ["a a a a a"] * (n // 10 * 9 % 700)
        for cut in (1, 0.95, 0.85, 0.81, 0.79, 0.6):
            texts.append(" ".join(base[: max(1, int(n * cut))] + base[n:]))
    total, cells = zip(*(nd.coarse(t, 5) for t in texts))
    bags = [bag(t) for t in texts]
    to_one = np.array([similarity(b, bags[20]) for b in bags])
    for part in (np.zeros(len(texts), int), np.arange(len(texts)) % 2, (np.arange(len(texts)) % 5 > 0).astype(int)):
        asked = {(i, j) for j in range(len(texts)) for i in range(j) if not part.any() or part[i] != part[j]}
        counted = []
        for near in (np.zeros(len(texts)), to_one):
            one, two = nd.possible_pairs(np.array(total), list(cells), np.arange(len(texts)), part, near, 0.8)
            found = {(min(p), max(p)) for p in zip(one.tolist(), two.tolist())}
            assert len(found) == len(one)
            assert {p for p in asked if similarity(bags[p[0]], bags[p[1]]) >= 0.8} <= found < asked
            counted.append(len(found))
        assert counted[1] <= counted[0]


def test_truncation_chains_inside_large_groups(spark):
    """In each group one text is linked by a single other one, which is soon in the class of a more central text."""
    random.seed(5)
    rows = []
    for g in range(40):
        base = [f"g{g}-{k}" for k in range(400)]
        cuts = random.sample(range(336, 401), 25) + [324, 264]
        rows += [(100 * g + k, " ".join(base[:cut])) for k, cut in enumerate(cuts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = found_classes(nd.classes(spark, docs).collect())
    assert got == brute_classes(rows) and len(got) == 40


def test_members_of_different_classes_meet(spark, monkeypatch):
    """Whoever may be alike meets in some block, and a block holds no more than a part and a chunk, about."""
    monkeypatch.setattr(nd, "_PART", 8)
    monkeypatch.setattr(nd, "_CHUNK", 20)
    random.seed(7)
    rows = []
    for bucket in range(12):
        labels = [bytes([random.choice([1, 1, 1, 1, 2, 2, 2, 3, 4, 5])]) for _ in range(random.choice([3, 30, 120]))]
        rows += [(bucket, bytes([7, bucket, i % 256, i // 256]), label, random.random()) for i, label in enumerate(labels)]
    frame = spark.createDataFrame(rows, "bucket long, node binary, label binary, near double")
    dealt = nd.meetings(spark, frame, 0.8).collect()
    blocks = defaultdict(list)
    for r in dealt:
        blocks[r.bucket, r.crowd and bytes(r.crowd), r.i, r.j].append((bytes(r.node), bytes(r.label), r.part))
    met = set()
    for (bucket, crowd, i, j), block in blocks.items():
        assert len(block) < 80
        for a in block:
            for b in block:
                if a[1] != b[1] and (a[2] != b[2] or crowd is None and i == j):
                    met.add((bucket, *sorted((a[0], b[0]))))
    for bucket, a, la, va in rows:
        for other, b, lb, vb in rows:
            if bucket == other and la != lb and abs(va - vb) <= 0.2:
                assert (bucket, *sorted((a, b))) in met


def test_a_stray_costs_one_pass_over_a_class(spark):
    """A class of 100,000 in one bucket and a stray of another: about a row for each member, and none if it is out of reach."""
    n = 100_000
    members = spark.range(n).select(
        F.lit(1).cast("long").alias("bucket"), F.encode(F.concat(F.lit("m"), F.col("id").cast("string")), "utf-8").alias("node"),
        F.lit(b"class").alias("label"), (F.lit(0.8) + F.pmod(F.xxhash64("id"), F.lit(1000)) / 5000).alias("near"),
    )

    def dealt(near):
        stray = spark.createDataFrame([(1, b"stray", b"stray", near)], members.schema)
        return nd.meetings(spark, members.unionByName(stray), 0.8).count()

    assert n <= dealt(0.85) <= 1.01 * n
    assert dealt(0.3) == 0
    assert dealt(0.65) < 0.3 * n


def test_a_run_broadcasts_within_its_budget(spark):
    rows = spark.range(1000).select(F.col("id").alias("k"), F.col("id").alias("n"))
    budget = common.Budget(100_000)
    assert [budget.takes(rows) for _ in range(5)] == [True, True, True, False, False]
    assert budget.left >= 0 and budget.takes(rows.limit(10))


def test_recall_of_planted_copies(spark):
    """All copies of similarity 0.8 or more are found, whatever was changed: words cut off, replaced, moved, or repeated."""
    random.seed(12)
    rows, pairs = [], []
    for k in range(150):
        words = [f"w{random.randrange(5000)}" for _ in range(random.choice([30, 120, 500]))]
        copy, edits = list(words), random.choice([1, 2, 3, 6, 12])
        for _ in range(edits):
            kind, at = random.random(), random.randrange(len(copy))
            if kind < 0.4:
                copy[at] = f"x{random.random()}"
            elif kind < 0.6:
                del copy[at]
            elif kind < 0.8:
                copy[at:at] = copy[: random.randrange(8)]
            else:
                copy = copy[at:] + copy[:at]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(copy))]
        pairs.append((2 * k, 2 * k + 1, similarity(bag(rows[-2][1]), bag(rows[-1][1]))))
    got = {r.doc_id: r.class_id for r in nd.classes(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    near = [(a, b) for a, b, s in pairs if s >= 0.8]
    assert len(near) > 40 and all(got[a] == got[b] for a, b in near)
    assert all(got[a] != got[b] for a, b, s in pairs if s < 0.8)
