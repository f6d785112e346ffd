"""A9 parses the sockets text once."""

from __future__ import annotations

from quarry.functions.scalars import links


def test_links_parse_their_text_once(spark):
    texts = spark.createDataFrame([(0, '[{"group":1},{"group":2},{"group":2}]'), (1, '[{},{"group":null},{"group":3}]'), (2, "[]"), (3, None), (4, "x"), (5, "[null,{}]")],
                                  "k int, s string")
    found = texts.select("k", links("s").alias("n"))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert {r["k"]: r["n"] for r in found.collect()} == {0: 2, 1: 2, 2: 0, 3: 0, 4: 0, 5: 2}
