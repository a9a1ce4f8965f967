"""End-to-end run over small export folders written as CSV."""

import datetime as dt
import os


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_pipeline_and_backtest(spark, tmp_dir):
    from metricwatch.config import DEFAULT
    from metricwatch.plans.pipeline import run_backtest, run_pipeline
    start = dt.date(2025, 1, 1)
    hdr = "ASIN,Date,Refund rate %,Conversion,Margin,ACoS,TACoS,Sales,Units,Orders,Title"
    lines = [hdr]
    for i in range(40):
        d = start + dt.timedelta(days=i)
        sales = 1000 + (i % 3) * 10 if i < 39 else 200          # a collapse on the last day
        for a in ("b00x1", "b00x2"):
            lines.append(f"{a},{d:%m-%d-%Y},1.0,12.0,25.0,20.0,8.0,{sales},{sales // 10},{sales // 20},Item {a}")
    _write(f"{tmp_dir}/sellerise/all.csv", lines)
    last = start + dt.timedelta(days=39)
    _write(f"{tmp_dir}/returns/Returns {last:%Y-%m-%d}.csv",
           ["asin,return-date,quantity,reason", f"B00X1,{last:%Y-%m-%d}T10:00:00,2,DEFECTIVE"])
    _write(f"{tmp_dir}/inventory/Restock Inventory {last:%b} {last.day}, {last.year}.csv",
           ["asin,Total Units,available", "B00X1,10,5", "B00X2,0,0"])
    _write(f"{tmp_dir}/helium10/sub/listing {last:%Y-%m-%d}.csv",
           ["ASIN,Category BSR,Reviews Rating,Review Count", "b00x1,1200,4.5,100", "b00x2,800,3.2,50"])
    folders = {k: f"{tmp_dir}/{k}" for k in ("sellerise", "returns", "inventory", "helium10")}
    cfg = DEFAULT.with_(suppress_less_than_single=False)
    out = run_pipeline(spark, folders, cfg, run_date=last + dt.timedelta(days=2),
                       snapshot_store=f"{tmp_dir}/store", export_path=f"{tmp_dir}/export")
    assert out["reference_date"] == last
    day = out["day_alerts"].collect()
    assert {r["date"] for r in day} == {last}
    sales_alerts = [r for r in day if r["metric"] == "sales"]
    assert sales_alerts and all(r["severity"] == "critical" for r in sales_alerts)
    assert out["master"].filter("asin = 'B00X1'").select("category_bsr").first()[0] == 1200.0
    subject = out["subject"].first()["subject"]
    assert "Critical" in subject
    assert spark.read.parquet(f"{tmp_dir}/export").count() == len(day)
    bt = run_backtest(spark, folders, cfg)
    assert bt["range"].first()["last_date"] == last
    assert bt["by_tier"].count() == 5
