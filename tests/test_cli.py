"""The forecast commands of the command line on a small targets table."""

import datetime as dt
import json
import os
import tempfile

from sensorflow.__main__ import main


def test_forecast_commands(spark, capsys):
    root = tempfile.mkdtemp(prefix="sensorflow-cli-")
    # a year before and the weeks up to the issue date: the climatology needs the same
    # days of year in earlier years
    days = [dt.date(2023, 1, 20) + dt.timedelta(days=i) for i in range(40)]
    days += [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(40)]
    rows = [(d, "BARC", v, 10.0 + (i % 3)) for i, d in enumerate(days)
            for v in ("temperature", "oxygen")]
    spark.createDataFrame(rows, "time date, site_id string, variable string, "
                                "observed double").write.parquet(f"{root}/targets")
    main(["climatology", "--local", "--targets", f"{root}/targets", "--as-of",
          "2024-02-09", "--out", root, "--horizon", "3"])
    main(["persistence", "--local", "--targets", f"{root}/targets", "--as-of",
          "2024-02-09", "--out", root, "--horizon", "3"])
    out = capsys.readouterr().out.split()
    assert [os.path.basename(p) for p in out] == [
        "aquatics-2024-02-10-climatology.csv.gz", "aquatics-2024-02-10-persistence.csv.gz"]
    from sensorflow.sources import readers, schemas
    for path in out:
        f = readers.read_forecast(spark, path, schemas.CLIMATOLOGY_FORECAST)
        assert f.count() == 2 * 3 * 2           # series x days x (mu, sigma)
    main(["months", "--local", "--targets", f"{root}/targets", "--as-of", "2024-02-20"])
    plan = json.loads(capsys.readouterr().out)
    assert {p["fetch_month"] for p in plan} == {"2024-02", "2024-03"}


def test_empty_forecast_is_not_written(spark):
    import pytest

    from sensorflow.sources.sinks import write_forecast
    empty = spark.createDataFrame([], "time date, site_id string, variable string")
    with pytest.raises(ValueError):
        write_forecast(empty, tempfile.mkdtemp(), "aquatics", "climatology")
