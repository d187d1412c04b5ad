import random

import pytest
from pyspark.sql import functions as F

from hyetos.llm import graph, line_dedup, similarity_join
from tests.llm.conftest import invented


def groups(n, linked):
    """The least member of each connected group of 0..n-1."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(n):
        for b in range(a):
            if linked(a, b):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return [find(x) for x in range(n)]


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


def varied(seed, base, n, edits):
    """``n`` copies of the words ``base``, each with up to ``edits`` words changed."""
    source = random.Random(seed)
    for i in range(n):
        own = list(base)
        for _ in range(source.randint(0, edits)):
            own[source.randrange(len(own))] = f"new{seed}{i}{source.randrange(9)}"
        yield own


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7), (5, 0), (None, 3), (50, 60)]
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.root for r in graph.components(frame).collect()}
    assert found == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 102: 100, 50: 50, 60: 50}
    assert graph.components(frame.limit(0)).count() == 0


def test_a_round_of_components_has_few_tasks(spark, monkeypatch):
    """Where partitions are not merged, a round takes little more than three tasks for each of them."""
    wide = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before, states = {key: spark.conf.get(key) for key in wide}, []
    state = graph._state
    monkeypatch.setattr(graph, "_state", lambda links: states.append(state(links)) or states[-1])
    source = random.Random(3)
    edges = [(source.randrange(900), source.randrange(900)) for _ in range(700)]
    frame = spark.createDataFrame(edges, "a long, b long").repartition(4).persist()
    frame.count()
    context = spark.sparkContext
    try:
        for key, value in wide.items():
            spark.conf.set(key, value)
        context.setJobGroup("components", "components")
        found = {r.node: r.root for r in graph.components(frame).collect()}
    finally:
        context._jsc.clearJobGroup()
        for key, value in before.items():
            spark.conf.set(key, value)
        frame.unpersist()
    linked = {frozenset(edge) for edge in edges}
    roots = groups(900, lambda a, b: frozenset((a, b)) in linked)
    ends = {end for edge in edges if edge[0] != edge[1] for end in edge}
    assert found == {end: roots[end] for end in ends}
    tracker = context.statusTracker()
    stages = {s for job in tracker.getJobIdsForGroup("components") for s in tracker.getJobInfo(job).stageIds}
    tasks = sum(tracker.getStageInfo(s).numCompletedTasks for s in stages if tracker.getStageInfo(s))
    assert tasks < (len(states) + 1) * 64 * 5


@pytest.mark.parametrize("small", [48, 6])
def test_join_like_all_pairs(spark, make_docs, odd_docs, monkeypatch, small):
    monkeypatch.setattr(similarity_join, "SMALL", small)
    monkeypatch.setattr(similarity_join, "BLOCK_SETS", 20)
    texts = []
    for seed in range(4):
        texts += [" ".join(w) for w in varied(seed, invented(seed, 120), 25, 4)]
    shared = invented(99, 40)
    texts += [" ".join(shared + invented(200 + i, 60)) for i in range(30)]
    texts += ["a b", "A, b!", "a b c", "", None]
    docs = make_docs(texts).unionByName(odd_docs.withColumn("doc_id", F.col("doc_id") + 1000))
    rows = [(r.doc_id, r.text) for r in docs.collect()]

    def plain(text):
        raw = (text or "").lower()
        own = "".join(c if c.isalnum() or ord(c) > 127 else " " for c in raw).split(" ")
        own = [w for w in own if w]
        size = min(5, len(own))
        return {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()

    sets = [plain(t) for _, t in rows]
    alike = lambda a, b: jaccard(sets[a], sets[b]) >= 0.8
    root = groups(len(rows), alike)
    least = {}
    for (doc_id, _), r in zip(rows, root, strict=True):
        least[r] = min((x for x in (least.get(r), doc_id) if x is not None), default=None)
    expected = [
        (rows[i][0], least[root[i]], sum(alike(i, j) for j in range(len(rows)) if j != i))
        for i in range(len(rows))
    ]
    found = [tuple(r) for r in similarity_join.join(docs).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_join_of_nothing(no_docs):
    assert similarity_join.join(no_docs).count() == 0


def test_enough_runs():
    assert similarity_join.runs_for(0.8, 0.99999) * similarity_join.BRANCHES <= 128
    assert similarity_join.runs_for(0.8, 0.5) == 1


def line_expectation(rows, threshold=0.8):
    lines = [(d, n, x.strip(" ").lower()) for d, t in rows if t is not None
             for n, x in enumerate(t.split("\n")) if x.strip(" ")]
    size = line_dedup.SHINGLE
    different = sorted({x for _, _, x in lines})
    sets = [{x[i : i + size] for i in range(max(len(x) - size, 0) + 1)} for x in different]
    root = groups(len(different), lambda a, b: jaccard(sets[a], sets[b]) >= threshold)
    of = {x: r for x, r in zip(different, root, strict=True)}
    first = {}
    for d, n, x in lines:
        key = (d is None, d or 0, n)
        first[of[x]] = min(first.get(of[x], key), key)
    return [(d, n, None if first[of[x]][0] else first[of[x]][1], first[of[x]][2],
             first[of[x]] == (d is None, d or 0, n)) for d, n, x in lines]


def test_lines_like_all_pairs(spark, make_docs, odd_docs):
    source, texts = random.Random(3), []
    pool = [" ".join(w) for s in range(6) for w in varied(s, invented(s, 30), 25, 3)]
    for i in range(60):
        own = [source.choice(pool) for _ in range(3)] + [" ".join(invented(500 + i, 12))]
        own += ["Short", "SHORT ", "", "\t"]
        texts.append("\n".join(source.sample(own, len(own))))
    docs = make_docs([*texts, None, "", texts[0]]).unionByName(
        odd_docs.withColumn("doc_id", F.col("doc_id") + 1000)
    )
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = [tuple(r) for r in line_dedup.line_classes(docs).collect()]
    assert sorted(found, key=repr) == sorted(line_expectation(rows), key=repr)


def test_pivots_lose_no_link_far_from_the_top(spark):
    # a chain: each line is close to the next, the most frequent is far from the ends
    base = list("abcdefghijklmnopqrstuvwxyz0123456789" * 3)
    chain = ["".join(base)]
    for i in range(0, 100, 4):
        base[i] = "#"
        chain.append("".join(base))
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(chain + [chain[12]] * 3)], "doc_id long, text string")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = [tuple(r) for r in line_dedup.line_classes(docs, 0.6).collect()]
    assert sorted(found) == sorted(line_expectation(rows, 0.6))


@pytest.mark.parametrize("middle", [20, 1024])
def test_far_lines_of_one_bucket_lose_no_link(spark, monkeypatch, middle):
    monkeypatch.setattr(line_dedup, "MIDDLE", middle)
    monkeypatch.setattr(line_dedup, "_bands", lambda columns: F.array(F.lit(1)))  # one bucket for all
    source, lines = random.Random(11), []
    text = lambda n: "".join(source.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    template = text(40)
    for _ in range(200):
        own = text(100)
        lines += [template + own, template + own[:-12] + text(12)]
    rows = list(enumerate(lines))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [tuple(r) for r in line_dedup.line_classes(docs).collect()]
    assert sorted(found) == sorted(line_expectation(rows))
    assert sum(r[-1] for r in found) == 200


@pytest.mark.parametrize(("seed", "middle"), [(1, 8), (2, 1024)])
def test_lines_in_between_lose_no_link(spark, monkeypatch, seed, middle):
    # walks away from a few texts, in one bucket: near, in between and far of every pivot
    monkeypatch.setattr(line_dedup, "_bands", lambda columns: F.array(F.lit(1)))
    monkeypatch.setattr(line_dedup, "SMALL", 4)
    monkeypatch.setattr(line_dedup, "MIDDLE", middle)
    source, lines = random.Random(seed), []
    for _ in range(4):
        start = source.choices("abcdefghijklmnopqrstuvwxyz", k=160)
        for _ in range(6):
            walk = list(start)
            for _ in range(source.randint(1, 8)):
                for _ in range(source.randint(1, 2)):
                    walk[source.randrange(160)] = source.choice("ABCDEF0123456789")
                lines.append("".join(walk))
    rows = list(enumerate(lines + source.sample(lines, 10)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [tuple(r) for r in line_dedup.line_classes(docs).collect()]
    expected = line_expectation(rows)
    assert sorted(found) == sorted(expected) and 4 < sum(r[-1] for r in expected) < len(rows) - 20


def test_bounds_are_never_below_the_similarity(spark):
    source, lines = random.Random(5), ["", "a", "ab" * 400, "x" * 9, "x" * 30]
    for size in (5, 12, 40, 300, 3000):
        text = source.choices("abcdefgh ", k=size)
        for edits in (0, 1, 3, size // 10):
            for _ in range(edits):
                text[source.randrange(size)] = source.choice("XYZ")
            lines.append("".join(text))
    texts = spark.createDataFrame(list(enumerate(lines)), "node long, normal string")
    pairs = [(a, b) for a in range(len(lines)) for b in range(len(lines))]
    pairs = spark.createDataFrame(pairs, "a long, b long")
    maps = line_dedup.bit_maps(texts)
    exact = {(r.a, r.b): r.similarity for r in line_dedup.similarities(pairs, texts).collect()}
    bound = {(r.a, r.b): r.bound for r in line_dedup.bounds(pairs, maps).collect()}
    assert bound.keys() == exact.keys() and all(bound[p] >= exact[p] - 1e-12 for p in exact)
    kept = {tuple(r) for r in line_dedup.links(pairs, texts, maps, 0.8).collect()}
    assert kept == {p for p, similarity in exact.items() if similarity >= 0.8}


def test_sets_are_built_once(spark):
    texts = spark.createDataFrame([(1, "abc" * 30), (2, "abc" * 30 + "x"), (3, "short")], "node long, normal string")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3)], "a long, b long")
    maps = line_dedup.bit_maps(texts)
    assert {r.node: r.size for r in maps.collect()} == {1: 3, 2: 4, 3: 1}
    sized = line_dedup.bounds(pairs, maps)
    scored = line_dedup.similarities(sized, texts)
    assert {(r.a, r.b): r.similarity for r in scored.collect()} == {(1, 2): 3 / 4, (1, 3): 0.0, (2, 3): 0.0}
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (maps, scored)]
    assert "lambda" not in plans[0]
    assert "array_union" in plans[1] and "array_intersect" not in plans[1]


def test_only_lines_that_meet_others_are_joined(spark):
    rows = [(1, "a line of its own\nthe same line\n"), (2, "THE same line \nanother that comes once"), (None, "nobody's line"),
            (3, "twice here\ntwice here"), (4, "row twice"), (4, "row twice")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [tuple(r) for r in line_dedup.line_classes(docs).collect()]
    assert sorted(found, key=repr) == sorted(line_expectation(rows), key=repr)
    lines = line_dedup.nodes(line_dedup.split_lines(docs))
    wanted = lines.groupBy("node").count().where("count > 1")
    kept = {(r.doc_id, r.line_no) for r in line_dedup.marked(lines, "node", wanted).where("may").collect()}
    assert kept >= {(1, 1), (2, 0), (3, 0), (3, 1), (4, 0)} and len(kept) < 8
    assert line_dedup.marked(lines, "node", wanted).count() == lines.count()


def test_documents_without_repeated_lines(spark, no_docs):
    rows = [(1, "One line of text here\n\nanother line", 9, "x"), (2, "ONE line of text here ", 9, "y"),
            (3, "fresh words\none line of text here", 9, None), (4, None, 9, "n"), (5, "", 9, ""),
            (6, "\n ", 9, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, lost string")
    found = {r.doc_id: (r.text, r.n_chars) for r in line_dedup.deduplicated(docs).collect()}
    assert found == {1: (rows[0][1], 9), 3: ("fresh words", 11), 4: (None, 9), 5: ("", 9), 6: ("\n ", 9)}
    assert line_dedup.deduplicated(docs).columns == docs.columns
    assert line_dedup.line_classes(no_docs).count() == line_dedup.deduplicated(no_docs).count() == 0
