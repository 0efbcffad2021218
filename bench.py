"""Time the headline queries and print one JSON line.

Reads ``BENCH_SF_DIR`` and ``BENCH_CPUS``. Each query is run once unmeasured
(class loading, code generation) and then timed, short ones as the best of two
runs, with every result row written to the no-op sink. ``--duckdb`` adds the seconds DuckDB needs for
the same SQL on as many threads.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from matchforge.session import build_session
from registry.oracle import ORACLE
from registry.queries import QUERIES

HEADLINE = (
    "mart_player_stats", "mart_player_champion_stats", "mart_champion_stats",
    "mart_position_stats", "mart_match_timeline", "mart_item_popularity",
    "vw_top_players", "vw_meta_champions", "vw_item_efficiency", "vw_timeline_trends",
    "flatten_matches", "flatten_dedup", "incremental_new_matches", "recent_matches_per_player",
    "dq_report", "expand_players", "meta_tiers", "wr_anomalies", "player_outliers",
    "player_style", "recommend_champions", "predict_lineup_winrate", "timeline_anomalies",
    "action_plan",
)


def timed(run) -> float:
    started = time.perf_counter()
    run()
    return time.perf_counter() - started


def duckdb_seconds(sf_dir: str, cpus: str, names) -> dict[str, float]:
    import duckdb

    con = duckdb.connect(config={"threads": int(cpus)})
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return {
        name: round(min(timed(lambda: con.execute(ORACLE[name]).to_arrow_table()) for _ in range(2)), 3)
        for name in names if name in ORACLE
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [a for a in sys.argv[1:] if not a.startswith("--")] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        def run():
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

        run()
        best = timed(run)
        if best < 5:
            best = min(best, timed(run))
        seconds[name] = round(best, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name,
    }
    if "--duckdb" in sys.argv:
        line["duckdb"] = duckdb_seconds(sf_dir, cpus, names)
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
