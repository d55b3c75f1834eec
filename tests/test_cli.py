from aurum.__main__ import main


def test_cli_list(capsys):
    assert main(["list"]) == 0
    out = capsys.readouterr().out.split()
    assert "gold_fact" in out and "gate_report" in out


def test_cli_query_and_gate(spark, capsys):
    assert main(["query", "count_by_dim", "--sf", "/root/testdata/sf0.001"]) == 0
    assert "zones" in capsys.readouterr().out
    # the gate's row floor (50,000 gold rows) cannot hold on the smallest tables
    assert main(["gate", "--sf", "/root/testdata/sf0.001"]) == 1
