from tallyforge.__main__ import main


def test_cli_list_and_query(spark, capsys):
    assert main(["list"]) == 0
    assert "aum_by_segment" in capsys.readouterr().out.split()
    assert main(["query", "aum_by_segment", "--sf-dir", "/root/testdata/sf0.001", "--rows", "5"]) == 0
    assert "investor_segment" in capsys.readouterr().out
