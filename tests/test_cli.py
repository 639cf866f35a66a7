from slipway.__main__ import main


def df_of(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id bigint")


def test_cli_promote_state_revert(spark, store, capsys):
    store.build({"t": df_of(spark, [1])})
    out = main(["promote", store.root], spark=spark)
    assert out["tables"]["t"]["row_count"] == 1
    store.build({"t": df_of(spark, [1, 2])})
    main(["promote", store.root, "t"], spark=spark)
    assert main(["state", store.root], spark=spark)["tables"]["t"]["row_count"] == 2
    out = main(["revert", store.root, "t"], spark=spark)
    assert out["tables"]["t"]["row_count"] == 1
    assert main(["checks", store.root], spark=spark) == {"gate": []}
    hist = main(["history", store.root, "--env", "green"], spark=spark)["history"]
    assert [h["action"] for h in hist] == ["publish", "publish", "revert"]
    assert main(["expire", store.root], spark=spark) == {"deleted": []}
    assert '"seq"' in capsys.readouterr().out
