"""A mean halfway between two results is rounded the same in any order of its rows."""

from curatrix.plans import registry

#: The sum is 11.441, the mean 0.7150625; added as floats, most orders fall short of it.
VALUES = [0.572, 0.629, 0.539, 0.837, 0.551, 0.513, 0.873, 0.956, 0.843, 0.656, 0.715, 0.546, 0.988, 0.792, 0.652, 0.779]


def test_steps_by_subgraph_rounds_halves_up(spark, tmp_path):
    rows = [(f"t{g}-{i}", 1, None, None, v, None, None, f"sg{g}") for g in range(200) for i, v in enumerate(VALUES)]
    columns = "trajectory_id string, step_id int, content string, step_type string, confidence double, entities_involved array<string>, relations_used array<string>, subgraph_id string"
    spark.createDataFrame(rows, columns).write.parquet(str(tmp_path / "reasoning_steps.parquet"))
    graphs = [(f"sg{g}", [("a", "x"), ("b", "x")]) for g in range(200)]
    spark.createDataFrame(graphs, "subgraph_id string, nodes array<struct<id:string,type:string>>").write.parquet(str(tmp_path / "subgraphs.parquet"))
    got = registry.queries()["steps_by_subgraph"](spark, str(tmp_path)).collect()
    assert len(got) == 200 and {tuple(r)[1:] for r in got} == {(16, 0.715063, 2)}
