from collections import Counter

from conftest import rows
from pyspark.sql import functions as F

from gridspark.llm import tiles
from gridspark.session import settled


def test_rows_of_all_tasks_of_a_cell_and_its_neighbour(spark):
    sizes = {(1, 0): 3, (1, 1): 1, (1, 2): 4, (1, 5): 2, (2, 1): 2}  # tiles of (group, cell); a cell has 6 rows a tile
    made = [(g, c, 1000 * g + 100 * c + k) for (g, c), n in sizes.items() for k in range(6 * n)]
    table = spark.createDataFrame([*made, (None, 1, 9), (1, None, 10)], "group long, cell long, h long")
    sub = {r["h"]: r["sub"] for r in table.where("cell is not null and group is not null").join(
        spark.createDataFrame([(*k, n) for k, n in sizes.items()], "group long, cell long, n int"), ["group", "cell"])
        .select("h", F.pmod(F.xxhash64("h"), F.col("n")).cast("int").alias("sub")).collect()}
    want = []
    for (g, c), n in sizes.items():
        pairs = [(c, i, c, j) for i in range(n) for j in range(i, n)]
        pairs += [(c, i, c + 1, j) for i in range(n) for j in range(sizes.get((g, c + 1), 0))]
        for a, i, b, j in pairs:
            want += [(g, a, i, b, j, 0, h) for x, y, h in made if (x, y) == (g, a) and sub[h] == i]
            want += [(g, a, i, b, j, 1, h) for x, y, h in made if (x, y) == (g, b) and sub[h] == j and (a, i) != (b, j)]
    got = tiles.paired(table, "h", F.ceil(F.count(F.lit(1)) / 6))
    assert got.columns == [*tiles.KEYS, "side", "h"]
    assert Counter(rows(got)) == Counter(want)


def test_tasks_are_no_table(spark):
    # a cell of n tiles has n * n / 2 tasks: as a table they compress to a few bits each, and were broadcast from the driver
    before = set(settled(spark))
    table = spark.range(400).select(F.lit(1).cast("long").alias("group"), (F.col("id") % 4).alias("cell"), F.col("id").alias("h"))
    n = tiles.paired(table, "h", F.count(F.lit(1))).count()
    assert n == 4 * 100 * 100 + 3 * 2 * 100 * 100  # a row meets every tile of its own cell and of the cells beside it
    assert max(spark.read.parquet(p).count() for p in settled(spark) if p not in before) <= 4
