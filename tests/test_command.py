from __future__ import annotations

import csv

import pyarrow.parquet as pq
import pytest

from sparksales.__main__ import JOBS, main
from sparksales.schema import RAW_COLUMNS

ROWS = [
    {"index": str(number), "Date": date, "Status": status, "Fulfilment": "Merchant", "ship-service-level": "Standard",
     "Style": "ST1", "SKU": f"ST1-{size}", "Size": size, "Courier Status": "Shipped", "Qty": "1", "Amount": amount,
     "ship-city": "HUE", "ship-state": "Goa", "promotion-ids": promotions}
    for number, (date, status, size, amount, promotions) in enumerate(
        [
            ("04-01-22", "Shipped", "XXL", "100", "A,B,C"),
            ("04-03-22", "Shipped", "M", "90.5", "A,B,C"),
            ("02-30-22", "Cancelled", "M", "10", "A, B, C"),
            ("bad", "Cancelled", "M", "", ""),
        ]
    )
]


@pytest.fixture
def export(tmp_path):
    path = tmp_path / "sales.csv"
    with open(path, "w", newline="") as handle:
        writer = csv.DictWriter(handle, RAW_COLUMNS)
        writer.writeheader()
        writer.writerows(ROWS)
    return str(path)


def run(export, tmp_path, job, *options):
    target = tmp_path / job
    main([job, export, str(target), "--single-file", *options])
    if "parquet" in (JOBS[job].format, *options) and "csv" not in options:
        return pq.read_table(target).to_pylist()
    with open(target, newline="") as handle:
        return list(csv.DictReader(handle))


def test_every_job_writes_rows(spark, export, tmp_path, capsys):
    for job in JOBS:
        assert run(export, tmp_path, job, "--explain")
    assert "Physical Plan" in capsys.readouterr().out


def test_results(spark, export, tmp_path):
    winners = run(export, tmp_path, "winning-size")
    assert winners[0] == dict(
        state="Goa", window_date="2022-04-02", winning_size="XXL", purchase_count="1", population_variance="0.0", window_length="10"
    )
    assert run(export, tmp_path, "median-variety") == [dict(month="2022-04", state="GOA", median_variety="2.0")]
    (city,) = run(export, tmp_path, "city-percentage")
    assert city == dict(
        city="HUE", cancelled_standard_order_count=2, qualifying_order_count=1, qualifying_order_percentage=50.0
    )


def test_options(spark, export, tmp_path):
    months = {row["month"] for row in run(export, tmp_path, "threshold-deviation", "--clamp-days", "--format", "csv")}
    assert months == {"2022-02", "2022-04"}
    target = tmp_path / "folder"
    main(["median-variety", export, str(target)])
    assert target.is_dir()
    with pytest.raises(FileExistsError):
        main(["median-variety", export, str(target)])
