"""The command line runs the whole flow on synthetic exports."""

from costmart.__main__ import main


def test_cli_synthetic_run(spark, scratch, capsys):
    out = scratch("cli-mart")
    assert main(["--synthetic", "300", "--out", out, "--reports", "all"]) == 0
    text = capsys.readouterr().out
    for name in ("spend_by_provider", "category_share", "aiml_spend", "net_gross_credits", "fact_cloud_costs"):
        assert name in text
    assert spark.read.parquet(f"{out}/fact_cloud_costs").count() == 600
