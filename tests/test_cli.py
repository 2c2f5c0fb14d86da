"""The command line drives the same jobs."""

from __future__ import annotations

from weir.__main__ import main
from weir.plans import staging
from weir.plans.jobs import DERBY_DRIVER, _derby_url
from weir.sources import read_table


def test_cli_sensor_stream(spark, scratch, sf_small):
    topic = staging.sensor_topic(spark, sf_small)
    table = scratch("cli_table")
    assert main(["sensor-stream", "--topic-files", topic, "--files-per-trigger", "4",
                 "--table", table, "--checkpoint", scratch("ck")], spark=spark) == 0
    assert spark.read.parquet(table).count() == jobs_rows(spark, sf_small)


def jobs_rows(spark, sf_dir):
    from weir.plans.jobs import sensor_flatten
    return sensor_flatten(spark, sf_dir).count()


def test_cli_weather_and_records(spark, scratch, sf_small, capsys):
    url = _derby_url(spark, "cli")
    assert main(["weather-load", "--path", staging.weather_documents(spark, sf_small), "--core-only",
                 "--url", url, "--table", "W", "--driver", DERBY_DRIVER], spark=spark) == 0
    assert read_table(spark, url, "W", driver=DERBY_DRIVER).count() == \
        staging.table(spark, sf_small, "events").count()
    assert main(["records-refresh", "--path", staging.record_documents(spark, sf_small), "--csv", scratch("csv"),
                 "--url", url, "--table", "R", "--driver", DERBY_DRIVER], spark=spark) == 0
    assert "loaded rows=" in capsys.readouterr().out


def test_cli_land(spark, scratch, capsys):
    src = scratch("src")
    spark.createDataFrame([("a\nb",)], "payload string").write.json(src)
    assert main(["land", "--source", src, "--path", scratch("landing")], spark=spark) == 0
    assert "landed" in capsys.readouterr().out
