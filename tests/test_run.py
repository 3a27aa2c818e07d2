import datetime as dt
import json
import pathlib

import pytest
from pyspark.sql import functions as F

from tidegrain import config
from tidegrain.plans import reports, run
from tidegrain.sources import bronze, collector
from tidegrain.sources.store import TableStore
from tidegrain.streaming.ingest import ingest_available

UTC = dt.timezone.utc
T0 = dt.datetime(2026, 9, 28, 12, 3, tzinfo=UTC)


def put(base, at, payload, meta=True):
    p = pathlib.Path(base) / f"{at:%Y/%m/%d}"
    p.mkdir(parents=True, exist_ok=True)
    (p / f"{at:%H%M%S}.json").write_text(payload if isinstance(payload, str) else json.dumps(payload))
    if meta:
        (p / f"{at:%H%M%S}.meta.json").write_text(meta if isinstance(meta, str) else json.dumps({"ingested_at": at.isoformat()}))


def record(name, local, n):
    return {"Dato": f"{local:%d.%m.%Y}", "Klokkeslett": f"{local:%H:%M}", "Sted": name, "Latitude": "58.97", "Longitude": "5.73", "Antall_ledige_plasser": n}


def snapshot(raw, i, n="100"):
    at = T0 + dt.timedelta(minutes=5 * i)
    local = dt.datetime(2026, 9, 28, 14, 0) + dt.timedelta(minutes=5 * i)
    put(raw, at, [record("A", local, str(300 - i)), record("B", local, n)])


def derived(store):
    names = ["silver_parking_reading", "silver_stale_period", "silver_quarantine", "fact_parking_availability", "fact_parking_hourly", "fact_suggested_price"]
    return {n: sorted(map(str, store.read(n).collect())) for n in names}


def setup(spark, raw, tables):
    week = [{"from": "00:00", "to": "24:00", "price": 20}]
    return run.Setup(TableStore(spark, str(tables)), str(raw), mapping=[("A", 1, 0), ("B", 2, 0)], tariff_list=[{"facility": n, "periods": week} for n in "AB"])


def test_incremental_runs_equal_a_rebuild(spark, tmp_path):
    raw = tmp_path / "raw"
    for i in (0, 2, 3):
        snapshot(raw, i)
    c = setup(spark, raw, tmp_path / "a")
    assert run.run(c) == 0
    snapshot(raw, 1, "x")  # arrives late
    put(raw, T0 + dt.timedelta(minutes=3), [record("A", dt.datetime(2026, 9, 28, 14, 10), "7")])  # an earlier fetch of a later reading takes over
    snapshot(raw, 5)
    assert run.run(c) == 0 and run.run(c) == 0
    again = setup(spark, raw, tmp_path / "b")
    assert run.run(again) == 0
    assert derived(c.store) == derived(again.store)
    reasons = {r["reason"] for r in c.store.read("silver_quarantine").collect()}
    assert reasons == {"not_a_count", "conflicting_duplicate"}
    before = derived(c.store)
    run.run_silver(c, rebuild=True)
    run.run_gold(c)
    assert derived(c.store) == before
    r = reports.Report({n: c.store.read(n) for n in c.store.tables()})
    assert r.latest_card().first()[0] == 295 + 100 and r.facility_table().count() == 3 and r.status_cards().first()["source_status"] == "Fresh"
    for page in (r.free_spaces_line, r.occupancy_matrix, r.stale_timeline, r.covered_minutes, r.stale_periods, r.failed_checks):
        page().collect()


def test_critical_check_and_failed_step(spark, tmp_path):
    raw = tmp_path / "raw"
    snapshot(raw, 0)
    put(raw, T0 + dt.timedelta(hours=1), [])
    c = setup(spark, raw, tmp_path / "t")
    assert run.run(c) == 3
    failed = {r["check"] for r in c.store.read("quality_check_results").where("not passed").collect()}
    assert {"empty_snapshot", "schema_drift"} <= failed
    assert run.run(setup(spark, tmp_path / "none", tmp_path / "u"), say=lambda _: None) == 1


def test_bad_files_have_one_reason(spark, tmp_path):
    raw = tmp_path / "raw"
    for i, (payload, meta) in enumerate([("[]", False), ("[]", "{"), ("<html>", True), ('{"a":1}', True), ("[1]", True), ("[]", True), ('[{"a":true,"b":{"c":1},"d":null,"e":3650}]', True)]):
        put(raw, T0 + dt.timedelta(minutes=i), payload, meta)
    files = bronze.classify(bronze.text_files(spark, str(raw)), "s")
    assert [r["reason"] for r in files.orderBy("raw_file").collect()] == ["missing_sidecar", "unreadable_sidecar", "unreadable_payload", "unreadable_payload", "unreadable_payload", "no_records", None]
    row = bronze.widen(bronze.rows(files.where("reason is null")), ["a", "b", "d", "e", "zz"]).first()
    assert (row["a"], row["b"], row["d"], row["e"], row["zz"], row["record_index"]) == ("true", '{"c":1}', None, "3650", None, 0)
    with pytest.raises(ValueError, match="raw_file"):
        bronze.widen(bronze.rows(files), ["raw_file"])


def test_stream_loads_each_file_once(spark, tmp_path):
    raw, st = tmp_path / "raw", TableStore(spark, str(tmp_path / "t"))
    snapshot(raw, 0)
    for _ in range(2):
        ingest_available(spark, str(raw), st, "feed", "bronze_feed", str(tmp_path / "cp"))
    assert st.read("bronze_feed").count() == 2
    snapshot(raw, 1)
    ingest_available(spark, str(raw), st, "feed", "bronze_feed", str(tmp_path / "cp"))
    assert st.read("bronze_feed").count() == 4


def test_store(spark, tmp_path):
    st = TableStore(spark, str(tmp_path))
    df = lambda *r: spark.createDataFrame(list(r), "k int, v string")
    got = lambda v=None: sorted(tuple(r) for r in st.read("t", v).collect())
    st.append("t", df((1, "a")))
    assert st.append("t", df()) is None and st.versions("t") == [1]
    st.insert_if_new("t", df((1, "z"), (2, "b"), (2, "b")), ["k"])
    assert got() == [(1, "a"), (2, "b")]
    st.replace_where("t", F.col("k") == 1, df((3, "c")))
    assert got() == [(2, "b"), (3, "c")] and got(1) == [(1, "a")]
    st.append("t", spark.createDataFrame([(4, "d", 1.5)], "k int, v string, w double"))
    assert st.read("t").columns == ["k", "v", "w"] and st.read("t").where("w is null").count() == 2
    with pytest.raises(TypeError):
        st.append("t", spark.createDataFrame([("x", "y")], "k string, v string"))
    st.replace_tagged("t", "x", spark.createDataFrame([(5, "e", 0.5)], "k int, v string, w double"))
    st.replace_tagged("t", "x", spark.createDataFrame([(6, "f", 0.5)], "k int, v string, w double"))
    st.compact("t")
    assert sorted(r[0] for r in st.read("t").collect()) == [2, 3, 4, 6]
    st.replace_tagged("t", "x", spark.createDataFrame([], "k int, v string, w double"))
    n = len(st.versions("t"))
    with pytest.raises(ValueError):
        st.vacuum("t", 1)
    assert st.vacuum("t", 0, force=True, dry_run=True) and len(st.versions("t")) == n
    assert st.vacuum("t", 0, force=True) and len(st.versions("t")) == 1 and st.read("t").count() == 3
    assert st.read_or_empty("none", df().schema).count() == 0 and st.tables() == ["t"]
    st.overwrite("e", df())
    assert st.read("e").columns == ["k", "v"] and st.publish(["e", "none"]) == ["e"] and spark.table("e").count() == 0
    spark.sql("drop table e")


SOURCE = {"id": "a", "http": {"url": "https://x"}, "raw_path": "b/{yyyy}/{mm}/{dd}/{HHmmss}.json", "bronze_table": "t", "polling": {}}


class Net:
    """Answers by address; an exception is raised."""

    def __init__(self, answers):
        self.answers, self.asked = answers, []

    def get(self, url, params=None):
        self.asked.append((url, params))
        got = self.answers[url] if not callable(self.answers) else self.answers(url, params)
        if isinstance(got, Exception):
            raise got
        return collector.Answer(*got)


def source(tmp_path, **own):
    p = tmp_path / "one.json"
    p.write_text(json.dumps({"sources": [SOURCE | own]}))
    return config.load_sources(str(p))[0]


def test_collector(tmp_path):
    body = json.dumps([{"Sted": "A", "n": "1"}, {"Sted": "Z", "n": "2"}]).encode()
    own, home = source(tmp_path, filter={"field": "Sted", "mapping_field": "facility"}), tmp_path / "raw"
    do = lambda m, status=200, s=own, wanted=frozenset("AQ"): collector.Poll(home, s, Net({"https://x": (status, body)}), T0 + dt.timedelta(minutes=m), "r", wanted).run()
    assert do(0) == "stored" and do(1) == "not_due"
    side = collector.sidecars(home)[0]
    assert side["filter"]["missing"] == ["Q"] and side["filter"]["kept_records"] == 1 and side["polling_mode"] == "fast"
    assert side["content_hash"].startswith("sha256:") and side["values_fingerprint"].startswith("sha256:") and (home / "b/2026/09/28/120300.json").exists()
    for i in range(1, 5):
        assert do(5 * i) == "stored"
    assert collector.sidecars(home)[-1]["polling_mode"] == "slow" and do(30) == "not_due" and do(45) == "stored"
    assert [s["ingested_at"][14:16] for s in collector.sidecars(home, 2)] == ["23", "48"]
    assert do(90, 503) == "outage" == do(100, 503) and len(list((home / "b/unavailable").iterdir())) == 1
    with pytest.raises(collector.CollectError, match="404"):
        do(120, 404)
    with pytest.raises(collector.CollectError, match="no values to keep"):
        do(120, wanted=None)
    demand = config.Source("a", own.raw_path, "t", http=own.http)
    with pytest.raises(FileExistsError):
        do(45, s=demand)
    assert do(200, s=demand) == "stored" and collector.sidecars(home, 1)[0]["next_due"] is None


@pytest.mark.parametrize("body", [b"<html>", b'{"error": 1}', b'[{"Sted": "A"}, 3]', b"\xff", b"null"])
def test_a_payload_that_is_no_list_is_stored_under_a_filter(tmp_path, body):
    own = source(tmp_path, filter={"field": "Sted", "mapping_field": "facility"})
    assert collector.Poll(tmp_path / "raw", own, Net({"https://x": (200, body)}), T0, "r", frozenset("A")).run() == "stored"
    assert collector.sidecars(tmp_path / "raw")[0]["filter"]["applied"] is False
    assert (tmp_path / "raw/b/2026/09/28/120300.json").read_bytes() == body
    assert collector.narrowed(b"[{}]", "Sted", {"A"})[1]["missing"] == ["A"] and collector.narrowed(b"[]", "Sted", set())[1]["applied"]


def test_catalogue_errors():
    one = {"id": "i", "name": "n", "format": " JSON ", "url": "https://a/x"}
    at = "https://c/api/3/action/package_show"
    show = lambda r: json.dumps({"success": True, "result": {"name": "p", "resources": r}}).encode()

    def find(answer):
        return collector.only_resource(collector.package(Net({at: answer}), "https://c/", "p"), "json")

    assert find((200, show([one, {"format": "csv"}]))) == collector.Resource("i", "n", "JSON", "https://a/x")
    cases = [
        ((503, b""), "HTTP 503"), ((200, b"<html>"), "no JSON"), ((200, b'{"success": false, "error": "Not found"}'), "a refusal: Not found"), ((200, b"[]"), "a refusal"),
        ((200, b'{"success": true, "result": []}'), "success without a description"), ((200, show(None)), "no resource list"), ((200, show([{"format": "CSV"}])), r"no JSON resource \(available formats: CSV\)"),
        ((200, show([one, one | {"name": "second"}])), "2 JSON resources, expected exactly one.*second"), ((200, show([one | {"url": "http://a"}])), "no https download URL"), (collector.CollectError("request timed out"), "timed out"),
    ]
    for answer, message in cases:
        with pytest.raises(collector.CollectError, match=message):
            find(answer)


def test_transport(monkeypatch):
    import urllib.error

    def fails(e):
        def run(*_, **__):
            raise e

        monkeypatch.setattr("urllib.request.urlopen", run)

    for e, message in ((TimeoutError(), "timed out"), (urllib.error.URLError(TimeoutError()), "timed out"), (urllib.error.URLError("refused"), "request failed"), (ConnectionError("x"), "request failed")):
        fails(e)
        with pytest.raises(collector.CollectError, match=message):
            collector.Https().get("https://x", {"a": 1})


def test_config_reports_all_problems(tmp_path):
    p = tmp_path / "s.json"
    assert source(tmp_path).polling["slow_interval_minutes"] == 20 and source(tmp_path).folder == "b"
    bad = SOURCE | {"zz": 1, "http": {"url": "http://x", "y": 1}, "raw_path": "{mm}{yyyy}", "glitch": {"min_jump": 5}, "polling": {"fast_interval_minutes": 30}, "freshness": {"stale_after_minutes": True}}
    p.write_text(json.dumps({"sources": [bad, SOURCE, SOURCE | {"ckan": {}}, 3]}))
    with pytest.raises(config.ConfigError) as e:
        config.load_sources(str(p))
    assert len(e.value.problems) >= 12
    m = tmp_path / "m.json"
    m.write_text(json.dumps({"facilities": [{"facility": "A", "register_id": 1}, {"facility": "A", "register_id": 1, "reserved_spaces": 2}]}))
    with pytest.raises(config.ConfigError) as e:
        config.load_mapping(str(m))
    assert len(e.value.problems) == 3
    c = tmp_path / "c.json"
    c.write_text(json.dumps({"github_actions": {"repository": "a/b", "workflow": "w.yml"}}))
    assert config.load_collector(str(c)) == config.Collector("a/b", "w.yml")
    for text in ("{}", "[]", '{"github_actions": {"repository": 1}}', "x"):
        c.write_text(text)
        with pytest.raises(config.ConfigError):
            config.load_collector(str(c))


def test_tariff_and_rule_files(spark, tmp_path):
    from tidegrain.operators import pricing

    t, r = tmp_path / "t.json", tmp_path / "r.json"
    t.write_text(json.dumps({"unit": "half_hour", "facilities": [{"facility": "A", "periods": [{"from": "00:00", "to": "24:00", "price": 20}, {"weekdays": ["sat"], "from": "10:00", "to": "12:00", "price": 30}]}]}))
    grid = pricing.tariffs(spark, config.load_tariffs(str(t)))
    assert grid.count() == 168 and [x[0] for x in grid.where("weekday_number = 6 and hour = 11").select("base_price").collect()] == [60.0]
    t.write_text(json.dumps({"unit": "half_hour", "facilities": [{"periods": [{"from": 3, "to": "24:00", "price": -1, "weekdays": ["x"]}]}]}))
    with pytest.raises(config.ConfigError) as e:
        config.load_tariffs(str(t))
    assert len(e.value.problems) == 4
    good = {"occupancy_bands": [{"name": "a", "below": 0.5, "multiplier": 1}, {"name": "b", "below": None, "multiplier": 2}], "rush_hours": [{"name": "r", "weekdays": ["mon"], "from": "07:00", "to": "09:00", "multiplier": 1.1}], "limits": {"min_multiplier": 0.5, "max_multiplier": 1.5, "facilities": {"A": {"max": 30}}}, "data": {"max_stale_share": 0.5, "min_covered_minutes": 30}}
    r.write_text(json.dumps(good))
    rules = config.load_rules(str(r))
    assert rules.limits == {"A": (None, 30)} and rules.rush == (("r", (1,), 7, 9, 1.1),) and rules.bands[-1] == ("b", None, 2.0)
    for bad in (good | {"limits": {}}, good | {"occupancy_bands": []}, good | {"rush_hours": good["rush_hours"] * 2}):
        r.write_text(json.dumps(bad))
        with pytest.raises(config.ConfigError):
            config.load_rules(str(r))


def test_two_feeds_with_files_of_one_time(spark, tmp_path):
    st, out = TableStore(spark, str(tmp_path / "t")), []
    for feed in "ab":
        snapshot(tmp_path / feed, 0)
        out.append(run.Setup(st, str(tmp_path / feed), feed))
    assert run.run(out, say=out.append) in (0, 3)
    assert {(r[0], r[1]) for r in st.read("silver_parking_fetch").groupBy("source_id").count().collect()} == {("a", 2), ("b", 2)}
    snapshot(tmp_path / "b", 1)
    assert run.run(out[:2]) in (0, 3) and st.read("silver_parking_fetch").count() == 6
    assert {r[0] for r in st.read("fact_parking_availability").select("source_id").distinct().collect()} == {"a", "b"}


def test_command_line(spark, tmp_path):
    from tidegrain import cli

    raw, tables, said = tmp_path / "raw", str(tmp_path / "tables"), []
    p = tmp_path / "s.json"
    p.write_text(json.dumps({"sources": [SOURCE]}))
    local = dt.datetime(2026, 9, 28, 14, 0)
    body = json.dumps([record("A", local, "7")]).encode()
    a = cli.arguments().parse_args(["collect", "--config", str(p), "--storage", str(raw), "--run-id", "1"])
    assert cli.collect(a, Net({"https://x": (200, body)}), T0, said.append) == 0 and said == ["a: stored"]
    assert cli.collect(a, Net({"https://x": (404, b"")}), T0 + dt.timedelta(hours=1), said.append) == 1
    m = tmp_path / "m.json"
    m.write_text(json.dumps({"facilities": [{"facility": "A"}]}))
    go = lambda *x: cli.main([*x, "--tables-root", tables], spark, said.append)
    files = ["--config", str(p), "--raw-root", str(raw), "--mapping", str(m)]
    assert go("run", *files) == 0 and go("silver", *files, "--rebuild") == 0 and go("check", *files) == 0
    st = TableStore(spark, tables)
    assert st.read("silver_parking_fetch").count() == 1 and st.read("t").select("raw_file").first()[0] == "b/2026/09/28/120300.json"
    assert go("maintain", "--dry-run") == 0 == go("maintain") and st.read("silver_parking_fetch").count() == 1
    assert cli.main(["gaps", "--config", str(p), "--storage", str(raw)], spark, said.append) == 0 and "none since" in said[-1]
    assert cli.main(["run", "--config", str(m), "--raw-root", "x", "--tables-root", "y"], spark, said.append) == 2


def test_outages_and_run_history(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "unavailable"
    snapshot(raw, 0)
    out.mkdir()
    (out / "a.json").write_text(json.dumps({"observed_at": T0.isoformat(), "source_url": "https://x", "run_id": "1", "http_status": 503}))
    (out / "b.json").write_text("{}")
    c = setup(spark, raw, tmp_path / "t")
    c.outage_root = str(out)
    attempts = [1]

    def answer(url, params):
        if url.endswith("jobs"):
            return 200, json.dumps({"jobs": [{"steps": [{"name": f"fetch{url.split('/')[-2]}", "conclusion": "failure"}]}]}).encode()
        if params["page"] == 2:
            return 200, b'{"workflow_runs": []}'
        return 200, json.dumps({"workflow_runs": [{"id": 5, "run_attempt": attempts[0], "run_started_at": T0.isoformat(), "html_url": "u"}]}).encode()

    net = Net(answer)
    c.history = collector.History(net, config.Collector("a/b", "w"), size=1)
    for _ in range(2):
        run.run_bronze(c)
    assert sum(u.endswith("jobs") for u, _ in net.asked) == 1  # a known attempt isn't asked for again
    attempts[0] = 2
    run.run_bronze(c)
    assert [r["http_status"] for r in c.store.read("bronze_source_outages").collect()] == [503]
    assert [r["failed_step"] for r in c.store.read("bronze_collect_runs").collect()] == ["fetch2"]
    c.history = collector.History(Net(lambda *_: (500, b"")), config.Collector("a/b", "w"))
    run.load_runs(c, say=lambda _: None)
    assert c.store.read("bronze_collect_runs").count() == 1
    c.history = None
    assert run.run(c) == 0
    failed = {r["check"]: r["detail"] for r in c.store.read("quality_check_results").where("not passed").collect()}
    assert failed["collect_failures"] == "fetch2: 1" and failed["source_outages"].startswith("feed: 1 over 0")
