"""Payload files as scrapers write them: one pretty-printed envelope per file
without positions, picked per carrier by modification time."""

import json
import os

from quayside import config as C
from quayside.sources import payload as PL


def _record(k):
    return {"Container_Number": f"BOXU000000{k}", "Status": "Gate in", "Date": "2023-02-03", "Time": "04:05",
            "Concat_1": f"one{k}", "Concat_2": f"two{k}", "Concat_3": f"three{k}"}


def _write(folder, name, carrier, records, when=0):
    body = {"carrier": carrier, "scraped_at": "20230204_000000", "total_events": len(records), "records": records}
    path = folder / name
    path.write_text(json.dumps(body, indent=2))
    os.utime(path, (1_700_000_000 + when, 1_700_000_000 + when))


def test_read_pretty_printed_envelopes(spark, tmp_path):
    d = tmp_path / "payloads"
    d.mkdir()
    _write(d, "a.json", C.HLCU, [_record(k) for k in range(5)])
    (d / "b.json").write_text(json.dumps({"carrier": C.MAEU, "scraped_at": "20230204_000000", "total_events": 0}, indent=2))
    (d / "c.json").write_text('{"carrier": "HLCU", "records": [{')
    env = PL.read_envelopes(spark, str(d), multi_line=True)
    rows = sorted(PL.explode_envelopes(env).collect(), key=lambda r: r.ordinal)
    assert [(r.ordinal, r.Container_Number, r.Concat_3) for r in rows] == [(k, f"BOXU000000{k}", f"three{k}") for k in range(5)]
    checks = {r.check_name: r.n_payloads for r in PL.payload_checks(env).collect()}
    assert checks == {"ok": 1, "missing_field": 1, "corrupt_json": 1}
    rejects = str(tmp_path / "rejects")
    assert PL.load_payloads(spark, str(d), rejects, multi_line=True).count() == 5
    assert [r.file[-6:] for r in spark.read.parquet(rejects).collect()] == ["c.json"]


def test_a_run_in_parts_reads_as_one(spark, tmp_path):
    rows = [("HLCU", "20230204_000000", k, f"B{k}") for k in range(100)]
    ev = spark.createDataFrame(rows, "carrier string, scraped_at string, ordinal bigint, container_number string")
    found = []
    for bound in (7, 1000):
        path = str(tmp_path / str(bound))
        env = PL.build_envelopes(ev, bound)
        assert {r.total_events for r in env.collect()} == {100}
        PL.write_envelopes(env, path)
        read = PL.read_envelopes(spark, path)
        assert [(r.check_name, r.n_payloads, r.n_records) for r in PL.payload_checks(read).collect()] == [("ok", 1, 100)]
        found.append(sorted((r.ordinal, r.Container_Number) for r in PL.explode_envelopes(read).collect()))
    assert found[0] == found[1] == [(k, f"B{k}") for k in range(100)]


def test_latest_file_of_each_carrier_is_loaded(spark, tmp_path):
    d = tmp_path / "out"
    d.mkdir()
    _write(d, "hapag_lloyd_tracking_20230101_000000.json", C.HLCU, [_record(1)], 100)
    _write(d, "hapag_lloyd_tracking_20230102_000000.json", C.HLCU, [_record(2)], 300)
    _write(d, "maersk_tracking_20230101_000000.json", C.MAEU, [_record(3)], 200)
    (d / "notes.txt").write_text("{}")
    got = {r.carrier: r.file_name for r in PL.latest_file_per_carrier(PL.list_files(spark, str(d))).collect()}
    assert got == {C.HLCU: "hapag_lloyd_tracking_20230102_000000.json", C.MAEU: "maersk_tracking_20230101_000000.json"}
    rows = PL.load_latest(spark, str(d), str(tmp_path / "rejects")).collect()
    assert sorted((r.carrier, r.Container_Number) for r in rows) == [(C.HLCU, "BOXU0000002"), (C.MAEU, "BOXU0000003")]


def _envelope(names, **more):
    return json.dumps({"carrier": C.HLCU, "scraped_at": "20230204_000000", "total_events": 7, **more,
                       "records": [{"Container_Number": n} for n in names]})


def test_envelopes_of_one_file_keep_their_order(spark, tmp_path):
    """Without part numbers the place in the file decides, and equal envelopes
    are two envelopes."""
    d = tmp_path / "many"
    d.mkdir()
    (d / "run.json").write_text("\n".join(map(_envelope, ["AB", "CD", "AB", "E"])))
    rows = PL.load_payloads(spark, str(d), str(tmp_path / "rejects")).collect()
    assert sorted((r.ordinal, r.Container_Number) for r in rows) == list(enumerate("ABCDABE"))


def test_order_holds_over_the_pieces_of_a_large_file(spark, tmp_path):
    """A file that several tasks read in pieces."""
    d = tmp_path / "large"
    d.mkdir()
    names = [f"B{k:05d}" for k in range(3000)]
    (d / "run.json").write_text("\n".join(_envelope(names[k:k + 10]) for k in range(0, 3000, 10)))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        env = PL.read_envelopes(spark, str(d))
        assert env.select("block").distinct().count() > 3
        rows = PL.load_payloads(spark, str(d), str(tmp_path / "rejects")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted((r.ordinal, r.Container_Number) for r in rows) == list(enumerate(names))


def _runs(spark, stamps, n=5):
    rows = [(c, s, k, f"{c}{s}{k}") for c in (C.HLCU, C.MAEU, "OTHER") for s in stamps for k in range(n)]
    return spark.createDataFrame(rows, "carrier string, scraped_at string, ordinal bigint, container_number string")


def test_written_runs_are_found_again(spark, tmp_path):
    d = str(tmp_path / "runs")
    PL.write_run_files(PL.build_envelopes(_runs(spark, ["20230101_000000", "20230102_000000", "20230103_120000"]), 2), d)
    assert sorted(os.listdir(d))[-1].startswith("maersk") and len([f for f in os.listdir(d) if f[0] not in "._"]) == 6
    # An older run written later does not become the latest.
    PL.write_run_files(PL.build_envelopes(_runs(spark, ["20221231_000000"]), 2), d)
    got = PL.load_latest(spark, d, str(tmp_path / "rejects"), multi_line=False).collect()
    assert sorted((r.carrier, r.ordinal, r.Container_Number) for r in got) == [
        (c, k, f"{c}20230103_120000{k}") for c in (C.HLCU, C.MAEU) for k in range(5)]


def test_a_publication_that_died_is_finished_by_the_next_run(spark, tmp_path, monkeypatch):
    d = str(tmp_path / "died")
    publish = PL._publish
    monkeypatch.setattr(PL, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    try:
        PL.write_run_files(PL.build_envelopes(_runs(spark, ["20230101_000000"]), 10), d)
    except RuntimeError:
        pass
    assert PL.list_files(spark, d).count() == 0  # nothing half-written is listed
    monkeypatch.setattr(PL, "_publish", publish)
    PL.write_run_files(PL.build_envelopes(_runs(spark, ["20230102_000000"]), 10), d)
    assert PL.list_files(spark, d).count() == 4
