import json

import pytest

from riskforge.__main__ import main
from riskforge.session import CLUSTER_DEFAULTS
from tests.conftest import SMALL


@pytest.fixture
def restore_conf(spark):
    old = {k: spark.conf.get(k, None) for k in CLUSTER_DEFAULTS}
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_validate_and_test_commands(spark, capsys, tmp_path, restore_conf):
    assert main(["validate", "--testdata", SMALL, "--report-dir", str(tmp_path)]) == 1  # dirty rows fail
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["failed"] > 0 and out["report"].startswith(str(tmp_path))
    assert main(["test", "--testdata", SMALL]) == 1
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert res["tests"] == 47 and {r["test"] for r in res["failed"]} <= {
        "not_null", "unique", "accepted_values", "expression_is_true"}
