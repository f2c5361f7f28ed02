"""Python stages on workers that cannot import the package."""
from worker_runs import run


def test_overlap_and_bias(tmp_path):
    assert run("""
from gridspark.operators import bias, vegetation
cells = spark.createDataFrame([(0, 0.0, 0.1, [-0.01, -0.01, 0.01, 0.01], [0.09, 0.11, 0.11, 0.09])], "cell_id bigint, lat double, lon double, corner_lat array<double>, corner_lon array<double>")
pixels = spark.createDataFrame([(0, 0, 0.0, 1.0, 5.0, 6.0)], "iy int, ix int, lat_lo double, lat_hi double, lon_lo double, lon_hi double")
n = vegetation.overlap_pairs(cells, pixels)[0].count()
obs = spark.createDataFrame([(0, 1.0, float(i), 0, 1.0, 1.0 + i, 0.5, 0.0) for i in range(9)], "c int, p0 double, p1 double, qc0 int, err0 double, obs double, hofx double, bias double")
print(n, bias.solve_bias(bias.normal_sums(obs, ["p0", "p1"], ["c"]), ["p0", "p1"], ["c"]).count())
""", tmp_path) == "1 2"
