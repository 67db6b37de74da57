import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from rosterlake.llm import quality as q


def brute(text):
    words = q._words(text or "")
    counts = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if counts[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if q._words(x)]
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)]


def test_counts_equal_brute_force():
    random.seed(3)
    for _ in range(400):
        text = "".join(random.choice("ab  \n\t\x1c\x85é#|") for _ in range(random.randint(0, 120)))
        assert q.statistics(text)[0] == brute(text)
    assert q.repeated(["a", "b"] * 10) == (20, 2) and q.repeated([]) == (0, 0)


def test_trees_are_monotonic_and_learn():
    rng = np.random.default_rng(1)
    x = rng.random((3000, len(q.FEATURES)))
    y = (x[:, 2] + 0.3 * rng.random(3000) < 0.6).astype(float)
    trees = q.grow(x, y)
    assert ((trees.score(x) >= 0.5) == y).mean() > 0.85
    for f, sign in enumerate(q.FEATURES.values()):
        if sign:
            for row in x[:50]:
                line = np.repeat(row[None], 40, axis=0)
                line[:, f] = np.linspace(-1, 2, 40)
                assert (np.diff(trees.score(line)) * sign >= -1e-12).all()
    walked = trees.base + np.zeros(20)
    for root in trees.roots:  # one row and one tree at a time
        for i, row in enumerate(x[:20]):
            node = root
            while trees.left[node] != node:
                node = trees.left[node] if row[trees.feature[node]] <= trees.threshold[node] else trees.right[node]
            walked[i] += trees.value[node]
    assert np.allclose(1 / (1 + np.exp(-walked)), trees.score(x[:20]))


def test_held_out_accuracy_and_clean_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = q.judge(spark, docs, q.learn(docs, labels.filter("doc_id % 2 = 0"))).join(labels.filter("doc_id % 2 = 1"), "doc_id")
    right = found.filter("not base_failed").agg(F.avg((F.col("kept").cast("int") == F.col("quality")).cast("int"))).first()[0]
    assert right > 0.97


def test_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(5, 1), (6, 0), (None, 1), (7, None), (6, 0)], "doc_id long, quality int")
    docs = awkward.select("doc_id", "text", "kept", "score")
    trees = q.learn(docs, labels)
    out = q.judge(spark, docs, trees)
    assert out.count() == awkward.count() and q.judge(spark, nothing, trees).count() == 0
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[1].n_words == 0 and rows[1].base_failed and not rows[1].kept
    untaught = q.judge(spark, docs, q.learn(docs, labels.limit(0)))
    assert untaught.filter("kept = base_failed").count() == 0
