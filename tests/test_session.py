"""Session helpers and the plan-inspection CLI."""

from conftest import SF_SMALL


def test_checkpoint_dir_is_read_from_the_session(spark):
    from fraudflow.session import ensure_checkpoint_dir, work_path
    d = ensure_checkpoint_dir(spark)
    assert d and d == (spark.conf.get("spark.checkpoint.dir", None) or d)
    a, b = work_path(spark, "x"), work_path(spark, "x")
    assert a != b and a.startswith(d.rstrip("/"))


def test_explain_cli_prints_plans(spark, capsys):
    from fraudflow.plans.explain import main
    main(["fraud_loss_1d", "--sf", SF_SMALL, "--mode", "simple", "--master", "local[2]"])
    out = capsys.readouterr().out
    assert "===== fraud_loss_1d =====" in out and "PushedFilters" in out
