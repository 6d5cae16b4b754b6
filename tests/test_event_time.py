"""Event time on streams: late rows apart, alert episodes as state, and batches that run again."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hitlens.streaming import jobs, state

T0 = datetime(2025, 4, 1)
REQUESTS = "log_time timestamp, site string, client_ip string, is_success boolean, is_error boolean, is_slow boolean, duration_ms long, body_bytes long"


def requests(minutes, seed):
    rng = random.Random(seed)
    rows = []
    for m in minutes:
        for _ in range(rng.randint(1, 4)):
            bad = (m // 120) % 3 == 1 and rng.random() < 0.8
            ms = rng.randint(1, 9000)
            rows.append((T0 + timedelta(minutes=m, seconds=rng.randint(0, 59)), f"s{m % 2}", "c", not bad, bad, ms > 3000, ms, 10))
    return rows


def forget(folder, last):
    """As if the job had crashed before the commit of its last batch."""
    (folder / "commits" / str(last)).unlink()
    crc = folder / "commits" / f".{last}.crc"
    if crc.exists():
        crc.unlink()


def last_commit(folder):
    return max(int(p.name) for p in (folder / "commits").iterdir() if p.name.isdigit())


def test_rows_behind_the_watermark_are_kept_apart(spark, tmp_path):
    parts = [requests(range(0, 600), 1), requests([10, 400, 545, 570], 2), requests(range(600, 900), 3)]
    source, folder, checkpoint = tmp_path / "in", str(tmp_path / "out"), tmp_path / "checkpoint"
    latest, late, kept = None, [], []
    for rows in parts:
        spark.createDataFrame(rows, REQUESTS).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(REQUESTS).parquet(str(source))
        jobs.start_event_time(stream, ["site"], folder, str(checkpoint), late_seconds=3600).awaitTermination()
        for r in rows:
            (late if latest and r[0] < latest - timedelta(hours=1) else kept).append(r)
        latest = max([r[0] for r in rows] + ([latest] if latest else []))

    def check():
        got = jobs.read_rollup(spark, f"{folder}/state", ["site"]).collect()
        assert {r.site: (r.requests, r.errors) for r in got} == {s: (sum(r[1] == s for r in kept), sum(r[1] == s and r[4] for r in kept)) for s in ("s0", "s1")}
        assert sorted(r.log_time for r in spark.read.parquet(f"{folder}/late").collect()) == sorted(r[0] for r in late)

    assert late and len(late) < sum(len(p) for p in parts[1:2])
    check()
    forget(checkpoint, last_commit(checkpoint))
    stream = spark.readStream.schema(REQUESTS).parquet(str(source))
    jobs.start_event_time(stream, ["site"], folder, str(checkpoint), late_seconds=3600).awaitTermination()
    check()


def plain_episodes(rows, hold):
    """Episodes over hourly windows, in plain Python."""
    windows = {}
    for r in rows:
        windows.setdefault((r[1], r[0].replace(minute=0, second=0)), []).append(r)
    out = {}
    for (site, start), group in sorted(windows.items()):
        errors = 100 * sum(r[4] for r in group) / len(group)
        if errors > 20:
            seen = out.setdefault(site, [])
            if seen and start <= seen[-1][1] + hold:
                seen[-1][1], seen[-1][2], seen[-1][3] = start + timedelta(hours=1), seen[-1][2] + 1, max(seen[-1][3], errors)
            else:
                seen.append([start, start + timedelta(hours=1), 1, errors])
    return sorted((s, *e[:3], round(e[3], 6)) for s, es in out.items() for e in es)


@pytest.mark.parametrize("hold", [0, 7200])
def test_episodes_from_any_pieces(spark, hold):
    rows = requests([m for m in range(0, 3000) if (m // 60) % 7 != 3], 4)
    df = spark.createDataFrame(rows, REQUESTS)
    parts = jobs.pieces(jobs.windowed(df, "1 hour", by=["site"]), ["site"], error_rate=20, mean_ms=1e9)
    want = plain_episodes(rows, timedelta(seconds=hold))

    def found(made):
        return sorted((r.site, r.raised, r.until, r.windows, round(r.worst, 6)) for r in made.collect())

    whole = jobs.joined_up(parts, ["site"], hold_seconds=hold)
    assert found(whole) == want and len(want) > 4
    early = jobs.joined_up(parts.filter(F.col("raised") < F.lit(T0 + timedelta(hours=21))), ["site"], hold_seconds=hold)
    late = parts.filter(F.col("raised") >= F.lit(T0 + timedelta(hours=21)))
    assert found(jobs.joined_up(early.unionByName(late), ["site"], hold_seconds=hold)) == want
    assert jobs.joined_up(parts.limit(0), ["site"]).count() == 0


def test_episodes_of_a_stream_survive_a_replay(spark, tmp_path):
    first, second = requests(range(0, 1500), 5), requests(range(1500, 3000), 6)
    source, folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), tmp_path / "checkpoint"

    def run():
        stream = spark.readStream.schema(REQUESTS).parquet(source)
        windows = jobs.windowed(stream, "1 hour", late="10 minutes", by=["site"])
        jobs.start_episodes(windows, ["site"], folder, str(checkpoint), width_seconds=3600, error_rate=20, mean_ms=1e9).awaitTermination()

    def found():
        rows = jobs.read_episodes(spark, folder).collect()
        return sorted((r.site, r.raised, r.until, r.windows, round(r.worst, 6), r.state) for r in rows)

    for rows in (first, second):
        spark.createDataFrame(rows, REQUESTS).coalesce(1).write.mode("append").parquet(source)
        run()
    got = found()
    bound = max(r[0] for r in second) - timedelta(minutes=10)
    closed = [r for r in first + second if r[0].replace(minute=0, second=0) + timedelta(hours=1) <= bound]
    assert [e[:5] for e in got] == plain_episodes(closed, timedelta(0))
    assert {e[5] for e in got} >= {"cleared"}
    forget(checkpoint, last_commit(checkpoint))
    run()
    assert found() == got


def test_repeats_count_once(spark, tmp_path):
    source, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    rows = [(k, T0 + timedelta(minutes=k)) for k in range(100)]
    for part in (rows, rows[90:] + [(200, T0 + timedelta(minutes=95))]):
        spark.createDataFrame(part, "id long, log_time timestamp").coalesce(1).write.mode("append").parquet(source)
        stream = jobs.unique(spark.readStream.schema("id long, log_time timestamp").parquet(source), ["id"], "1 hour")
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [*range(100), 200]
    batch = spark.createDataFrame(rows + rows, "id long, log_time timestamp")
    assert jobs.unique(batch, ["id"]).count() == 100


def test_coarser_state(spark):
    rows = requests(range(0, 4000), 7)
    df = spark.createDataFrame(rows, REQUESTS).withColumn("stat_hour", F.date_trunc("hour", "log_time"))
    hours = state.partial(df, ["stat_hour", "site"])
    days = state.report(state.coarser(hours, {"day": F.to_date("stat_hour")}), ["day"])
    direct = state.report(state.partial(df.withColumn("day", F.to_date("log_time")), ["day"]), ["day"])
    exact = ["day", "requests", "successes", "errors", "slow", "bytes", "max_ms", "first_time", "last_time", "avg_ms", "std_ms", "clients_estimate"]
    assert sorted(days.select(*exact).collect()) == sorted(direct.select(*exact).collect())
    for r in days.collect():
        values = sorted(x[6] for x in rows if x[0].date() == r.day)
        assert values[int(0.93 * len(values))] <= r.p95_estimate <= values[min(int(0.97 * len(values)), len(values) - 1)]
    assert state.coarser(hours, {}).count() == 1


def test_cleared_episodes_do_not_come_back(spark, tmp_path):
    """Batches after which nothing is open: what was open before them is neither read nor taken up again."""
    source, folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def hour(h, bad):
        return [(T0 + timedelta(hours=h, minutes=m), "s", "c", not bad, bad, False, 5, 1) for m in range(3)]

    want = []
    for bad, hours in ((True, range(0, 3)), (False, range(3, 30)), (False, range(30, 40)), (True, range(40, 42)), (False, range(42, 60))):
        rows = [r for h in hours for r in hour(h, bad)]
        spark.createDataFrame(rows, REQUESTS).coalesce(1).write.mode("append").parquet(source)
        windows = jobs.windowed(spark.readStream.schema(REQUESTS).parquet(source), "1 hour", late="0 seconds", by=["site"])
        jobs.start_episodes(windows, ["site"], folder, checkpoint, width_seconds=3600, error_rate=20, mean_ms=1e9).awaitTermination()
        got = sorted((r.raised, r.until, r.windows, r.state) for r in jobs.read_episodes(spark, folder).collect())
        assert len({g[0] for g in got}) == len(got)
        want.append(got)
    at = lambda h: T0 + timedelta(hours=h)
    assert want[0] == [(at(0), at(2), 2, "open")]
    assert want[1] == want[2] == [(at(0), at(3), 3, "cleared")]
    assert want[-1] == [(at(0), at(3), 3, "cleared"), (at(40), at(42), 2, "cleared")]
