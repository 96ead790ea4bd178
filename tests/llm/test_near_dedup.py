import random

from flightlake.llm import near_dedup as N


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted((str(d), len(s), str(least.get(find(i)))) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def got(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in df.collect())


def edited(words, share, rng):
    return " ".join(rng.choice(["aa", "bb", "cc"]) + str(rng.random()) if rng.random() < share else w for w in words)


def test_equals_brute_force_with_a_large_group_of_near_copies(spark, docs_of):
    rng = random.Random(5)
    rows, n = [], 0
    for family, size in ((0, 150), (1, 3), (2, 30)):
        base = [f"f{family}w{i}" for i in range(120)]
        for _ in range(size):
            rows.append((n, edited(base, rng.choice([0.0, 0.01, 0.02, 0.04, 0.08]), rng)))
            n += 1
    passage = " ".join(f"shared{i}" for i in range(60))
    rows += [(n + i, passage + " " + " ".join(f"own{i}x{j}" for j in range(rng.choice([10, 40, 90])))) for i in range(90)]
    found = N.near_duplicates(docs_of(rows), leaf=8, depth=3)
    assert got(found) == brute(rows)


def test_odd_rows(odd):
    found = N.near_duplicates(odd)
    by = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in found.collect()}
    assert by[1, 36] == (1, True) and by[2, 36] == (1, False) and by[None, 36] == (1, False)
    assert by[3, 0] == (3, True) and by[4, 0] == (4, True) and by[5, 0] == (5, True) and by[None, 0] == (None, True)
    assert by[6, 1] == (6, True) and by[7, 1] == (6, False)
    assert len([1 for k, v in by.items() if v[0] == 8]) == 2


def test_keep_one_keeps_all_columns_and_one_of_each(odd):
    left = N.keep_one(odd)
    assert left.columns == odd.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == [1, 3, 4, 5, 6, 8]


def test_repeated_rows_leave_one(docs_of):
    left = N.keep_one(docs_of([(1, "a b c d e f"), (1, "a b c d e f"), (2, "other words here")]))
    assert sorted(r.doc_id for r in left.collect()) == [1, 2]


def test_empty_table(docs_of):
    assert N.near_duplicates(docs_of([])).count() == 0
    assert N.keep_one(docs_of([])).count() == 0


def test_a_group_of_near_copies_costs_its_size(spark, docs_of, monkeypatch):
    """No table of pairs or group members grows with the square of a group of near copies."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, edited(base, rng.choice([0.0, 0.01, 0.02, 0.03, 0.05]), rng)) for i in range(700)]
    sizes, real = {}, N.written

    def keep(spark, df, name):
        out = real(spark, df, name)
        sizes[name] = max(sizes.get(name, 0), out.count())
        return out

    monkeypatch.setattr(N, "written", keep)
    assert got(N.near_duplicates(docs_of(rows))) == brute(rows)
    paths = 1.5 * N.TREES * len(rows)
    assert sizes["level"] <= paths and sizes["mixed"] <= paths and sizes["open"] <= paths
    assert sizes["candidates"] <= 6 * len(rows) and sizes["links"] <= 6 * len(rows)


def test_index_finds_a_spanning_set_of_links():
    import numpy as np
    rng = random.Random(2)
    for _ in range(60):
        base = list(range(40))
        sets = [np.array(sorted(set(rng.sample(base, rng.randrange(20, 41)) + [100 + rng.randrange(5)])), np.uint64) for _ in range(rng.randrange(2, 25))]
        label = np.array([rng.randrange(len(sets)) for _ in sets])
        def groups(links):
            parent = list(range(len(sets)))
            def top(x):
                while parent[x] != x:
                    x = parent[x]
                return x
            for i in range(len(sets)):
                for j in range(i):
                    if label[i] == label[j]:
                        parent[top(i)] = top(j)
            for i, j in links:
                parent[top(i)] = top(j)
            return {tuple(sorted(k for k in range(len(sets)) if top(k) == top(i))) for i in range(len(sets))}
        everything = []
        for i in range(len(sets)):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                    everything.append((i, j))
        _, dense = np.unique(label, return_inverse=True)
        found = N._linked(sets, dense, 75, 100)
        assert set(found) <= {(i, j) for i, j in everything} | {(j, i) for i, j in everything}
        assert groups(found) == groups(everything) and len(found) < len(sets)


def test_shuffles_are_few(spark, docs_of, monkeypatch):
    """With many shuffle partitions each shuffle has its price, however small the tables: they are counted in the plans."""
    from flightlake.llm import graph
    rng = random.Random(4)
    base = [f"w{i}" for i in range(80)]
    rows = [(i, edited(base, rng.choice([0.0, 0.01, 0.02]), rng)) for i in range(30)]
    plans, real = [], N.written

    def keep(spark, df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
        return real(spark, df, name)

    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        monkeypatch.setattr(N, "written", keep)
        monkeypatch.setattr(graph, "written", keep)
        assert got(N.near_duplicates(docs_of(rows))) == brute(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert sum(plans) <= 32, plans


def test_components_by_broadcast_and_by_shuffle(spark, monkeypatch):
    from flightlake.llm import common, graph
    rng = random.Random(6)
    chain = [f"c{i:03}" for i in range(40)]
    rng.shuffle(chain)
    edges = list(zip(chain, chain[1:])) + [("hub", f"s{i}") for i in range(30)] + [("x", "x"), ("y", "z"), ("z", "y"), ("y", "z")]
    want = {x: min(chain) for x in chain} | {x: "hub" for x in ["hub", *(f"s{i}" for i in range(30))]} | {"x": "x", "y": "y", "z": "y"}
    table = common.written(spark, spark.createDataFrame([(a.encode(), b.encode()) for a, b in edges], "a binary, b binary"), "links")
    for most in (common.BROADCAST_ROWS, 0):
        monkeypatch.setattr(common, "BROADCAST_ROWS", most)
        found = [(bytes(r.node).decode(), bytes(r.label).decode()) for r in graph.components(table).collect()]
        assert len(found) == len(want) and dict(found) == want
    assert graph.components(table.where("false")).count() == 0


def test_large_sides_are_shuffled_with_the_same_result(docs_of, monkeypatch):
    from flightlake.llm import common
    rng = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, edited(base, rng.choice([0.0, 0.02, 0.05]), rng)) for i in range(25)] + [(25, None), (26, "own text"), (None, "own text")]
    for module, name in ((common, "BROADCAST_ROWS"), (N, "BROADCAST_ROWS"), (N, "BROADCAST_BYTES"), (N, "BROADCAST_SKETCHES")):
        monkeypatch.setattr(module, name, 0)
    assert got(N.near_duplicates(docs_of(rows), leaf=4, depth=2)) == brute(rows)
