"""Shared session and factories for landed match data."""

from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from matchforge.session import build_session  # noqa: E402

POSITIONS = ["TOP", "JUNGLE", "MID", "BOTTOM", "SUPPORT"] * 2


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def participant(number: int, **changes) -> dict:
    base = {
        "puuid": f"player-{number}", "riotIdGameName": f"Name {number}",
        "teamId": 100 if number < 5 else 200, "teamPosition": POSITIONS[number % 10],
        "role": "CARRY", "win": number < 5, "kills": 8, "deaths": 2, "assists": 5,
        "goldEarned": 12000, "totalMinionsKilled": 180, "neutralMinionsKilled": 20,
        "totalDamageDealtToChampions": 22000, "totalDamageTaken": 15000, "totalHeal": 500,
        "visionScore": 45, "wardsPlaced": 8, "wardsKilled": 3,
        "item0": 3031, "item1": 3006, "item2": 0, "item6": 3363,
        "championName": "Jinx" if number % 2 == 0 else "Thresh", "championId": 222,
    }
    return {**base, **changes}


def document(participants=None, **info) -> str:
    """Match document as JSON text, ten participants by default."""
    people = [participant(i) for i in range(10)] if participants is None else participants
    return json.dumps({"metadata": {}, "info": {
        "gameDuration": 1800, "gameVersion": "14.1.1", "gameEndTimestamp": 1700000000000,
        "gameMode": "CLASSIC", "participants": people, **info}})


def raw_frame(spark, *records):
    """Raw records from (match_id, document) pairs."""
    rows = [(match_id, text, "euw1") for match_id, text in records]
    return spark.createDataFrame(rows, "match_id STRING, _raw_json STRING, _region STRING")


def land(spark, raw_dir, chunk: str, *records) -> None:
    """Write one raw chunk file, named, in record order."""
    import pandas as pd

    folder = Path(raw_dir) / "matches"
    folder.mkdir(parents=True, exist_ok=True)
    pd.DataFrame(
        [(m, t, "euw1") for m, t in records], columns=["match_id", "_raw_json", "_region"]
    ).to_parquet(folder / f"{chunk}.parquet", index=False)
