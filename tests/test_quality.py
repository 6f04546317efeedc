"""Quality results and the gate."""

from auric.operators import quality as Q


def test_results_and_gate(spark):
    def ok(ctx):
        return spark.createDataFrame([("a", 100, 5), ("b", 0, 0)], "fonte string, total long, falhos long")

    def bad(ctx):
        return spark.createDataFrame([("a", 10, 9)], "fonte string, total long, falhos long")

    tests = [Q.QualityTest("T1", "ok", "validade", ">=", 90, "critica", ok),
             Q.QualityTest("T2", "baixa", "completude", ">=", 95, "media", bad)]
    res = {(r["teste_id"], r["fonte"]): r for r in Q.run_tests(tests, None, "r").collect()}
    assert res[("T1", "a")]["valor_medido"] == 95.0 and res[("T1", "a")]["aprovado"]
    assert res[("T1", "b")]["valor_medido"] == 100.0  # empty source counts as 100
    assert not res[("T2", "a")]["aprovado"]
    assert Q.gate_passes(Q.run_tests(tests, None, "r"))  # only a medium failure
    tests.append(Q.QualityTest("T3", "critico", "unicidade", ">=", 100, "critica", bad))
    assert not Q.gate_passes(Q.run_tests(tests, None, "r"))
