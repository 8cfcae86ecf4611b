"""The keyed permutation behind permutation importance."""

from pyspark.sql import functions as F

from binoscope.operators import explain


def _keys(repeats):
    return F.array(*[F.array(*[F.array(*[F.lit(k).cast("long") for k in ks]) for ks in explain.round_keys(7, r)]) for r in range(repeats)])


def _images(spark, rows, repeats):
    table = spark.range(rows).select("id", F.posexplode(_keys(repeats)).alias("repeat", "k"))
    return table.select("id", "repeat", explain.moved(F.col("id"), F.col("k"), rows).alias("image")).collect()


def test_every_size_is_permuted_exactly(spark):
    for rows in (1, 2, 3, 5, 7, 16, 97, 1009):
        made = _images(spark, rows, 3)
        for repeat in range(3):
            assert sorted(r.image for r in made if r.repeat == repeat) == list(range(rows))


def test_the_grid_leaves_few_places_over():
    for rows in (1, 2, 10, 999_983, 10 ** 9 + 7, 10 ** 11 + 3):
        a, b = explain.grid_of(rows)
        assert 0 <= a * b - rows <= 20 and a >= 2


def test_every_place_is_about_equally_likely(spark):
    made = _images(spark, 50, 400)
    count = [[0] * 50 for _ in range(50)]
    for r in made:
        count[r.id][r.image] += 1
    cells = [c for row in count for c in row]               # 8 expected, standard deviation 2.8
    assert max(cells) < 30
    assert sum((c - 8) ** 2 / 8 for c in cells) < 2401 + 5 * 70


def test_no_rows_and_rows_are_ranked_once(spark):
    rows = spark.range(40).select("id", (F.col("id") * 2).alias("a"), F.lit(1).alias("y"))
    assert explain.permuted(rows.limit(0), ["a"], 3, 42).count() == 0
    plan = explain.permuted(rows, ["a"], 10, 42)._jdf.queryExecution().optimizedPlan().toString()
    ranks = [line for line in plan.splitlines() if "row_number" in line]
    assert ranks and not any("repeat" in line for line in ranks)


def test_places_are_moved_by_arrays(spark):
    """The image by hand, one place at a time, and no function that is interpreted for every row and round."""
    rows = 37
    a, b = explain.grid_of(rows)
    keys = explain.round_keys(7, 2)

    def by_hand(place):
        while True:
            own, other, side, other_side = place // b, place % b, a, b
            for k in keys:
                total = 0
                for c in k:
                    total = (total * other + c) % explain.PRIME
                own, other, side, other_side = other, (own + total) % side, other_side, side
            place = own * b + other
            if place < rows:
                return place

    assert {r.id: r.image for r in _images(spark, rows, 3) if r.repeat == 2} == {i: by_hand(i) for i in range(rows)}
    made = explain.permuted(spark.range(rows).select("id", F.col("id").alias("a")), ["a"], 2, 42)
    assert "lambda" not in made._jdf.queryExecution().analyzed().toString()
