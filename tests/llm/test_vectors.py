import numpy as np
import pytest

from tickloom.llm import vectors


def rows(seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 16))
    out = []
    for c in centres:
        out += [c + rng.normal(scale=s, size=16) for s in (0.05, 0.2, 0.3, 0.4, 0.5)]
    out += list(rng.normal(size=(60, 16)))
    out += [centres[0]] * 40 + [centres[1] * 1e-200, centres[1] * 1e200, centres[1]]
    out = [[float(x) for x in v] for v in out]
    out += [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0]]
    ids = [int(x) for x in rng.permutation(len(out))]
    return [*zip(ids, out), (None, out[0]), (3, out[7])]


def brute(data, least=0.9):
    def sound(v):
        return bool(v) and None not in v and np.isfinite(v).all() and any(v)

    n = len(data)
    near = [[] for _ in range(n)]
    unit = [None if not sound(v) else np.array(v) / np.abs(v).max() for _, v in data]
    unit = [None if v is None else v / np.linalg.norm(v) for v in unit]
    for i in range(n):
        for j in range(n):
            if i != j and unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least:
                near[i].append(j)
    seen, out = {}, []
    for i in range(n):
        if i not in seen:
            group, todo = {i}, [i]
            while todo:
                for j in near[todo.pop()]:
                    if j not in group:
                        group.add(j)
                        todo.append(j)
            least_id = min((data[j][0] for j in group if data[j][0] is not None), default=None)
            seen |= dict.fromkeys(group, least_id)
        out.append((data[i][0], len(near[i]), seen[i], seen[i] == data[i][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize(("pivots", "block"), [(16, 8192), (3, 20), (40, 7)])
def test_against_brute_force(spark, pivots, block):
    data = rows()
    df = spark.createDataFrame([(i, v, "u", 1) for i, v in data], "vec_id long, embedding array<double>, uid string, home int")
    got = vectors.near_duplicates(df, pivots=pivots, block=block).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(data)


def test_table_against_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    data = [(r.vec_id, r.embedding) for r in df.collect()]
    got = sorted((tuple(r) for r in vectors.near_duplicates(df).collect()), key=str)
    assert got == brute(data)


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vectors.near_duplicates(df).count() == 0
    only_bad = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in vectors.near_duplicates(only_bad).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_forest():
    a, b = np.array([5, 9, 3, 100]), np.array([9, 3, 7, 101])
    node, root = vectors.forest(a, b)
    assert dict(zip(node.tolist(), root.tolist())) == {5: 3, 9: 3, 7: 3, 101: 100}


def test_query_matches_sql(spark):
    from compare import connect, difference, spark_result, sql_result
    from tickloom.llm.queries import QUERIES, SQL

    folder = "/root/testdata/sf0.01"
    got = spark_result(QUERIES["op9_vector_links"](spark, folder))
    assert difference(got, sql_result(connect(folder), SQL["op9_vector_links"])) is None


def test_sql_on_hostile_vectors(spark):
    """The statement itself against the operator, where vectors are null, empty, zero, equal or of several lengths."""
    import duckdb
    from compare import difference, spark_result, sql_result
    from tickloom.llm.queries import SQL

    rows = [
        (5, [1.0, 0.0]), (3, [2.0, 0.0]), (9, [0.95, 0.31]), (2, [0.5, 0.86]), (1, [0.0, 0.0]), (4, None), (6, []),
        (7, [1.0, None]), (8, [float("nan"), 1.0]), (10, [float("inf"), 1.0]), (11, [1.0, 0.0, 0.0]), (12, [3.0, 0.0, 0.1]),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    db = duckdb.connect()
    db.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    db.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    got = spark_result(vectors.near_duplicates(df))
    assert difference(got, sql_result(db, SQL["op9_vector_links"])) is None
