from conftest import plan_of
from vaultline.llm import queries


def test_the_mix_stays_in_the_jvm(spark, sf_dir):
    assert "Python" not in plan_of(queries.QUERIES["op1_mixing"](spark, sf_dir))
