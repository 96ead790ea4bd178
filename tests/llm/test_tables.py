"""Sharding, mixing, decontamination, nearest neighbours, the pipeline and the registry."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from flightlake.llm import decontaminate, mixing, neighbours, quality, sharding
from flightlake.llm.queries import MIXTURE, domain, oracle_sql, queries

SMALL = "/root/testdata/sf0.001"


def brute_shards(rows, shards=8):
    made = sorted(((zlib.crc32((t or "").encode()), d is not None, d or 0, len((t or "").encode()) + 1) for d, t in rows))
    total, largest = sum(r[3] for r in made), max((r[3] for r in made), default=0)
    start, group, out = 0, {}, []
    for crc, _, _, size in made:
        first, n = group.get(crc, (start, 0))
        group[crc] = (first, n + size)
        start += size
    start, slots = 0, {}
    for crc, known, d, size in made:
        first, n = group[crc]
        middle = 2 * first + n if n <= max(largest, total // (shards * 500)) else 2 * start + size
        shard = min(shards - 1, middle * shards // (2 * total))
        slots[shard] = slots.get(shard, -1) + 1
        out.append((str(d if known else None), size, crc, shard, slots[shard]))
        start += size
    return sorted(out)


def shards_of(docs):
    return sorted((str(r.doc_id), r.size, r.text_crc32, r.shard, r.slot) for r in sharding.shard_by_size(docs, 8).collect())


def test_shards_equal_brute_force(docs_of, small_docs, odd):
    hot = docs_of([(i, "copy " * 30) for i in range(400)] + [(1000 + i, f"text {i} " * (i % 40)) for i in range(600)])
    for docs in (small_docs, odd, hot):
        assert shards_of(docs) == brute_shards([(r.doc_id, r.text) for r in docs.collect()])
    assert sharding.shard_by_size(docs_of([]), 8).count() == 0


def test_shards_of_a_hot_text_are_near_equal(docs_of):
    rows = [(i, "copy " * 30) for i in range(1000)] + [(5000 + i, f"text {i} ") for i in range(2000)]
    sizes = sharding.shard_by_size(docs_of(rows), 8).groupBy("shard").agg(F.sum("size").alias("n")).collect()
    assert len(sizes) == 8 and max(r.n for r in sizes) - min(r.n for r in sizes) <= 2 * 151


def test_groups_of_equal_texts_over_a_boundary_stay_whole(docs_of):
    rng = random.Random(7)
    rows = [(i, "".join(rng.choices("abcdefgh ", k=100))) for i in range(4000)] + [(4000, "z" * 60_000)]
    made = sorted(zlib.crc32(t.encode()) for _, t in rows)
    edge = made[len(made) * 3 // 8]     # somewhere near the edge of shards 2 and 3
    best = min((abs(zlib.crc32(f"copy {k} ".ljust(100, "x").encode()) - edge), k) for k in range(30_000))[1]
    rows += [(5000 + i, f"copy {best} ".ljust(100, "x")) for i in range(400)]
    found = shards_of(docs_of(rows))
    assert found == brute_shards(rows)
    assert len({s for d, size, _, s, _ in found if size == 101 and int(d) >= 5000}) == 1


def test_empty_texts_and_repeated_rows_are_dealt_over_tasks(spark, docs_of, monkeypatch):
    rows = [(i, "") for i in range(20_000)] + [(50_000 + i, f"{i:04d} " * 400) for i in range(500)] + [(7, "again and again")] * 6000
    docs = docs_of(rows)
    parts, real = [], sharding.written

    def keep(spark, df, name):
        out = real(spark, df, name)
        if name == "positions":
            parts.extend(r["count"] for r in out.groupBy("range", "part").count().collect())
        return out

    monkeypatch.setattr(sharding, "written", keep)
    assert shards_of(docs) == brute_shards(rows)
    assert max(parts) <= 3 * len(rows) / sharding.LEAST_RANGES


def test_position_counts_bounds(spark):
    bounds = [3, 3, 7, 10, 22, 40, 41, 99]
    rows = spark.range(0, 120).select("id", sharding._position(F.col("id"), bounds).alias("at")).collect()
    assert all(r.at == sum(b <= r.id for b in bounds) for r in rows)


def plain_rates(p, tokens, targets, most=None):
    """Projected gradient on all documents, without grouping or Spark."""
    a = p / p.sum(axis=1, keepdims=True) * 0 + p
    now = (tokens[:, None] * a).sum(axis=0)
    wanted = np.array(targets) * now[0] / targets[0]
    rate, ahead, pace = np.ones(len(p)), np.ones(len(p)), 1.0
    length = 1 / np.linalg.eigvalsh((tokens[:, None, None] * a[:, :, None] * a[:, None, :]).sum(axis=0)).max()
    for _ in range(2000):
        new = np.maximum(0, ahead - length * a @ ((tokens[:, None] * ahead[:, None] * a).sum(axis=0) - wanted))
        new = np.minimum(new, most) if most else new
        after = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead, rate, pace = new + (pace - 1) / after * (new - rate), new, after
    return rate, wanted


@pytest.mark.parametrize("most", [None, 1.0])
def test_rates_equal_plain_projected_gradient(spark, most):
    rng = np.random.default_rng(1)
    p = np.vstack([rng.dirichlet([20, 1, 1], 150), rng.dirichlet([1, 20, 1], 60), rng.dirichlet([1, 1, 20], 40)])
    units = np.round(p * mixing.STEPS).astype(int)
    tokens = rng.integers(1, 500, len(p))
    rows = spark.createDataFrame([(int(t), [int(x) for x in u]) for t, u in zip(tokens, units)], "_tokens long, _p array<int>")
    targets = {"a": 0.7, "b": 0.2, "c": 0.1}
    steps = mixing.fit_rates(rows, list(targets), targets, most)
    got = np.array([r[0] for r in rows.select(mixing._rate(steps, most)).collect()])
    want, wanted = plain_rates(units / mixing.STEPS, tokens.astype(float), list(targets.values()), most)
    total = lambda r: (tokens[:, None] * r[:, None] * units / mixing.STEPS).sum(axis=0)
    assert np.abs(total(got) - total(want)).max() <= 0.01 * wanted.sum()
    assert got.min() >= 0 and (most is None or got.max() <= most)
    if most is None:
        assert np.abs(total(got) - wanted).max() <= 0.002 * wanted.sum()


def test_mixing_meets_targets_and_keeps_clean_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = mixing.mixing_rates(docs, labels, domain(), MIXTURE)
    got = rows.join(labels, "doc_id").where("quality = 1 and toxic = 0").select(F.avg("p_clean"), F.min("rate")).first()
    assert rows.count() == docs.count() and got[0] > 0.9 and got[1] >= 0
    kept = mixing.mix(docs, labels, domain(), MIXTURE, most=1.0)
    assert kept.columns == docs.columns and kept.count() == kept.select("doc_id").distinct().count()
    clean = labels.where("quality = 1 and toxic = 0").join(docs, "doc_id", "left_semi")
    assert clean.join(kept, "doc_id", "left_semi").count() >= 0.95 * clean.count()


def labelled_posteriors(spark, shares, n=20_000):
    """Near-certain posteriors of ``n`` documents, in domains of the given shares."""
    rng = np.random.default_rng(5)
    tokens = rng.integers(50, 500, n)
    kinds = rng.choice(len(shares), n, p=shares)
    kinds[:len(shares)] = range(len(shares))
    rows = [(i, int(t), [mixing.STEPS if j == k else 0 for j in range(len(shares))]) for i, (t, k) in enumerate(zip(tokens, kinds))]
    return spark.createDataFrame(rows, "doc_id long, _tokens long, _p array<int>")


@pytest.mark.parametrize("most", [None, 1.0])
def test_tokens_of_the_copies_meet_the_targets(spark, most):
    rows = labelled_posteriors(spark, [0.76, 0.12, 0.12])
    drawn = mixing.with_rates(rows, mixing.fit_rates(rows, list(MIXTURE), MIXTURE, most, "clean"), most, sure=0)
    totals = drawn.agg(*[F.sum(F.col("_tokens") * F.col("_copies") * F.col("_p")[i]) / mixing.STEPS for i in range(3)]).first()
    wanted = np.array(list(MIXTURE.values())) * rows.agg(F.sum(F.col("_tokens") * F.col("_p")[0])).first()[0] / mixing.STEPS / MIXTURE["clean"]
    assert np.abs(np.array(totals) / wanted - 1).max() <= 0.2
    assert drawn.where(f"_p[0] >= {mixing.SURE * mixing.STEPS} AND _copies < 1").count() == 0


@pytest.mark.parametrize("shares", [[0.9985, 0.001, 0.0005], [0.9995, 0.0004, 0.0001]])
def test_rare_domains_meet_their_targets(spark, shares):
    rows = labelled_posteriors(spark, shares).withColumn("_p", F.transform("_p", lambda x: F.when(x > 0, 998).otherwise(1)))
    steps = mixing.fit_rates(rows, list(MIXTURE), MIXTURE)
    rated = rows.withColumn("rate", mixing._rate(steps))
    now, got = (np.array(rated.agg(*[F.sum(F.col("_tokens") * r * F.col("_p")[i]) for i in range(3)]).first()) for r in (F.lit(1.0), F.col("rate")))
    wanted = np.array(list(MIXTURE.values())) * now[0] / MIXTURE["clean"]
    assert np.abs(got / wanted - 1).max() <= 0.001


def test_targets_out_of_reach_are_reported(spark):
    rows = labelled_posteriors(spark, [0.9985, 0.001, 0.0005])
    with pytest.warns(RuntimeWarning, match="out of reach.*low .* toxic"):
        mixing.fit_rates(rows, list(MIXTURE), MIXTURE, 1.0)


def test_mixing_odd_rows(spark, odd, docs_of):
    labels = spark.createDataFrame([(1, 1, 0), (2, None, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    rows = mixing.mixing_rates(odd, labels, domain(), MIXTURE).collect()
    assert len(rows) == 12 and all(r.rate >= 0 for r in rows) and sum(r.n_tokens == 0 for r in rows) == 4
    assert mixing.mix(odd, labels, domain(), MIXTURE, most=1.0).columns == odd.columns
    assert mixing.mixing_rates(docs_of([]), labels, domain(), MIXTURE).count() == 0


def words(n, rng):
    return [rng.choice(["the", "of", "and"]) if rng.random() < 0.4 else f"w{rng.randrange(3000)}" for _ in range(n)]


def edits(a, b):
    """Least word edits between a and any passage of b, by the textbook table."""
    above = [0] * (len(b) + 1)
    for i, x in enumerate(a):
        row = [i + 1]
        for j, y in enumerate(b):
            row.append(min(above[j] + (x != y), above[j + 1] + 1, row[j] + 1))
        above = row
    return min(above)


def test_leaks_equal_exact_edit_search(spark, docs_of):
    rng = random.Random(2)
    items = [words(rng.randrange(6, 50), rng) for _ in range(40)]
    docs = []
    for n in range(160):
        body = words(150, rng)
        if n % 2:
            item = list(items[n // 4])
            for _ in range(int(rng.choice([0, 0.08, 0.15, 0.2]) * len(item))):
                at = rng.randrange(len(item))
                what = rng.random()
                item[at: at + 1] = [] if what < 0.25 else [item[at], f"n{rng.randrange(10**9)}"] if what < 0.5 else [f"n{rng.randrange(10**9)}"]
            cut = rng.choice([0, 70, 150])
            body[cut:cut] = item
        docs.append((n, " ".join(body)))
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.edits for r in decontaminate.find_leaks(docs_of(docs), table).collect()}
    exact = {}
    for d, text in docs:
        for i, item in enumerate(items):
            e = edits(item, text.split()) if len(set(item) & set(text.split())) >= 0.7 * len(set(item)) else 99
            if e <= int(decontaminate.EDITS * len(item)):
                exact[d, i] = e
    assert not {k for k in found if k not in exact and k[0] % 2 == 0}
    assert len(set(exact) & set(found)) >= 0.97 * len(exact)


@pytest.mark.parametrize("n", [6, 8, 12, 16, 19, 20, 32])
def test_leaks_at_the_limit_of_edits(n):
    rng, found, tried = random.Random(n), 0, 40
    for _ in range(tried):
        item = np.array([rng.getrandbits(63) + 1 for _ in range(n)], np.uint64)
        text = item.copy()
        text[rng.sample(range(n), int(decontaminate.EDITS * n))] = [rng.getrandbits(63) + 1 for _ in range(int(decontaminate.EDITS * n))]
        around = np.array([rng.getrandbits(63) + 1 for _ in range(60)], np.uint64)
        index = decontaminate.build_index([(1, item)])
        rows = np.concatenate([around[:30], text, around[30:]])
        found += bool(list(decontaminate._search(rows, np.array([len(rows)]), index, decontaminate._unpacked(index))))
    assert found == tried if n < decontaminate.SEEDED else found >= 0.95 * tried


def test_passage_distance_equals_the_table():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = rng.integers(0, 5, rng.integers(1, 12)).astype(np.uint64), rng.integers(0, 5, rng.integers(0, 25)).astype(np.uint64)
        got, start, end = decontaminate.passage_distance(a, b)
        assert got == edits(a.tolist(), b.tolist()) == edits(a.tolist(), b[start:end].tolist())


def test_leaks_odd_rows(spark, odd, docs_of):
    base = " ".join(f"word{i}" for i in range(5, 25))
    table = spark.createDataFrame([(1, base, "x"), (1, base, "y"), (2, None, "x"), (3, "", "x"), (None, base, "x"), (4, "two words", "z")], "item_id long, text string, doc_id string")
    rows = decontaminate.find_leaks(odd, table).collect()
    assert sorted((str(r.doc_id), str(r.item_id), r.edits) for r in rows) == sorted(
        [(d, i, 0) for d in ("1", "2", "2", "None") for i in ("1", "1", "None")] + [("6", "4", 0), ("7", "4", 0)])
    clean = decontaminate.drop_leaks(odd, table)
    assert clean.columns == odd.columns and clean.count() == 6
    assert decontaminate.find_leaks(docs_of([]), table).count() == 0 and decontaminate.find_leaks(odd, table.limit(0)).count() == 0


def test_short_items_match_whole_and_unedited(spark, docs_of):
    """Items of 1 to 5 words, against a plain search; the words' order, case and neighbours vary."""
    rng = random.Random(5)
    some = [f"v{i}" for i in range(6)]
    items = [(n, [rng.choice(some) for _ in range(1 + n % 5)]) for n in range(30)]
    docs = [(n, [rng.choice(some) for _ in range(rng.randrange(0, 40))]) for n in range(60)]
    table = spark.createDataFrame([(i, " ".join(w).upper()) for i, w in items], "item_id long, text string")
    found = {(r.doc_id, r.item_id): (r.edits, r.first_word, r.last_word) for r in decontaminate.find_leaks(docs_of([(d, "\n".join(w)) for d, w in docs]), table).collect()}
    want = {}
    for d, text in docs:
        for i, item in items:
            at = [a for a in range(len(text) - len(item) + 1) if text[a:a + len(item)] == item]
            if at:
                want[d, i] = (0, at[0], at[0] + len(item) - 1)
    assert found == want and len(want) > 100


def test_leaks_in_scripts_without_spaces(spark, docs_of):
    item, thai = "天地玄黄宇宙洪荒日月盈昃辰宿列張寒来暑往", "กขคงจฉชซฌญฎฏฐฑฒณดตถท"
    table = spark.createDataFrame([(1, item), (2, thai), (3, "你好")], "item_id long, text string")
    edited = item[:7] + "水" + item[8:]
    docs = docs_of([(1, "前文" + item + "後文"), (2, "abc " + edited), (3, "ก" + thai), (4, "前文後文 plain words"), (5, "你 好"), (6, item[:9]), (7, "é ü ж – “quoted”")])
    rows = {(r.doc_id, r.item_id): (r.edits, r.first_word, r.last_word) for r in decontaminate.find_leaks(docs, table).collect()}
    assert rows == {(1, 1): (0, 2, 21), (2, 1): (1, 1, 20), (3, 2): (0, 1, 20), (5, 3): (0, 0, 1)}
    assert [r.doc_id for r in decontaminate.drop_leaks(docs, table).orderBy("doc_id").collect()] == [4, 6, 7]


def test_benchmark_in_blocks_gives_the_same(spark, small_docs, monkeypatch):
    table = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    whole = sorted(map(tuple, decontaminate.find_leaks(small_docs, table).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 10)
    assert sorted(map(tuple, decontaminate.find_leaks(small_docs, table).collect())) == whole and whole


def exact_nearest(rows, k):
    """{query: [(distance, id)]} over usable vectors."""
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)]
    return {q: sorted((float(np.sqrt(((v - x) ** 2).sum())), i) for i, v in good if i != q and len(v) == len(x))[:k] for q, x in good if q % 100 == 0}


def test_nearest_reaches_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    exact = exact_nearest(rows, 10)
    found = {}
    points = neighbours.build_index(table.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector")), 10, shard_rows=128)
    asked = table.where("vec_id % 100 = 0").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))
    for r in neighbours.search(points, asked, 10).collect():
        found.setdefault(r.query_id, {})[r.rank] = (r.score, r.vec_id)
    hits = sum(len({i for _, i in exact[q]} & {i for _, i in found[q].values()}) for q in exact)
    assert found.keys() == exact.keys() and hits >= 0.95 * 10 * len(exact)
    for q, best in found.items():
        assert sorted(best) == list(range(1, 11)) and [best[r] for r in sorted(best)] == sorted(best.values())


def test_one_whole_shard_reaches_recall():
    """A shard of ``SHARD_ROWS`` points, evenly spread and in clusters, against brute force."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(64, 48)) * 3
    for points in (rng.normal(size=(neighbours.SHARD_ROWS, 32)), centres[rng.integers(0, 64, neighbours.SHARD_ROWS)] + rng.normal(size=(neighbours.SHARD_ROWS, 48)) * 0.3):
        graph = neighbours.build(points)
        assert graph.edges.shape == (len(points), neighbours.DEGREE) and not (graph.edges == np.arange(len(points))[:, None]).any()
        hits = 0
        for a in range(0, 512, neighbours.BATCH):
            asked = points[a: a + neighbours.BATCH] + 1e-3
            ids, far, _, _ = graph.search(asked, neighbours.BEAM_SEARCH)
            exact = ((points[None, :, :] - asked[:, None, :]) ** 2).sum(axis=2)
            for got, dist, want in zip(ids, far, exact):
                assert len(set(got.tolist())) == len(got) and np.allclose(dist, want[got])
                hits += len(set(got[:10].tolist()) & set(np.argsort(want)[:10].tolist()))
        assert hits >= 0.9 * 10 * 512


def test_query_blocks_give_the_same(spark, monkeypatch):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    whole = sorted(map(tuple, neighbours.nearest(table, F.col("id") % 5 == 0, 10).collect()))
    monkeypatch.setattr(neighbours, "QUERY_BYTES", 2_000)
    assert sorted(map(tuple, neighbours.nearest(table, F.col("id") % 5 == 0, 10).collect())) == whole and whole


def test_no_shuffle_carries_points_after_the_index(spark):
    found = neighbours.nearest(spark.read.parquet(f"{SMALL}/embeddings.parquet"), F.col("id") % 100 == 0, 10)
    plan = found._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange" in line]
    assert shuffles and all("points" not in line for line in shuffles) and "Join" not in plan


def test_nearest_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [None, 1.0]), (6, [float("inf"), 1.0]), (7, []),
            (8, [1.0, 0.0]), (9, [1.0, 0.0]), (10, [5.0, 5.0, 5.0]), (None, [1.0, 0.0]), (100, [2.0, 2.0]), (200, [1.0, 2.0, 3.0])]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, id string")
    got = {}
    for r in neighbours.nearest(table, F.col("id") % 100 == 0, 3).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    want = {q: [(n + 1, d, i) for n, (d, i) in enumerate(best)] for q, best in exact_nearest(rows, 3).items() if best}
    assert {q: sorted(v) for q, v in got.items()} == want
    assert neighbours.nearest(table.limit(0), F.col("id") % 100 == 0, 3).count() == 0


def test_many_copies_of_a_vector(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, 2.0]) for i in range(300)] + [(300 + i, rng.normal(size=2).tolist()) for i in range(50)]
    found = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") % 100 == 0, 10).collect()
    assert sorted((r.rank, r.vec_id) for r in found if r.query_id == 100) == [(i + 1, i) for i in range(10)]
    assert sorted((r.rank, r.vec_id) for r in found if r.query_id == 0) == [(i, i) for i in range(1, 11)]


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SMALL)
        if name != "sharding":
            assert after.columns == docs.columns
            assert after.exceptAll(before).isEmpty()
        before = after.cache()
    assert before.count() == corpus_pipeline.run(spark, SMALL).count() > 0


def test_pipeline_on_odd_and_empty_tables(spark, odd, docs_of):
    for docs in (odd, docs_of([])):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SMALL).cache()
            docs.count()


def test_registry_names_each_operator_once():
    names = list(queries())
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 11))
    assert set(oracle_sql()) <= set(names)
    assert quality.SAMPLE and corpus_pipeline.ORACLE_SQL is None
