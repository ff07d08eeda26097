"""Synthetic schedule feeds, and their rows put together one by one in Python.

The rows cover the awkward cases: orphan trips and routes, stops without a name, a stop in
two boroughs, hours past 23, an empty hour before a full one, leading zeros, the id ``NA``,
NULL directions, and equal counts around the tenth rank.
"""

from __future__ import annotations

import csv
import random
from collections import defaultdict
from pathlib import Path

BOROUGHS = {"North": "gtfs_n", "South": "gtfs_s", "Missing": "gtfs_x"}


def _write(folder: Path, table: str, header: str, rows: list[str]) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{table}.txt").write_text("\n".join([header, *rows]) + "\n")


def write_route_feed(folder: Path, seed: int = 1) -> Path:
    rng = random.Random(seed)
    stops = ["001", "01", "NA", *[f"S{i:02d}" for i in range(25)]]
    _write(
        folder,
        "stops",
        "stop_name,stop_id,stop_lat,stop_lon,location_type,parent_station",
        [
            f'"Stop {stop}, at the ""corner""",{stop},40.{i:02d},-73.{i:02d},0,'
            for i, stop in enumerate(stops)
        ],
    )
    _write(
        folder,
        "routes",
        "agency_id,route_id,route_short_name,route_color,route_desc",
        ["A,1,1,D82233,\"here, there\"", "A,2,2, 00AEEF ,plain", "A,SI,SIR,,no colour"],
    )
    trips, times = [], []
    for number in range(120):
        route = rng.choice(["1", "2", "SI", "9"])
        trips.append(f"{route},T{number:03d},{rng.choice(['0', '1', ''])},shape{number % 5}")
    for number in range(2500):
        trip = f"T{rng.randrange(130):03d}"
        stop = rng.choice([*stops, "unlisted"])
        hour = rng.choice([0, 5, 7, 8, 9, 14, 22, 23, 24, 25])
        clock = f"{hour:02d}" if hour > 9 or rng.random() < 0.9 else f" {hour}"
        times.append(f"{trip},{stop},{clock}:{rng.randrange(60):02d}:00,{number}")
    _write(folder, "trips", "route_id,trip_id,direction_id,shape_id", trips)
    _write(folder, "stop_times", "trip_id,stop_id,arrival_time,stop_sequence", times)
    return folder


def write_borough_feeds(base: Path, seed: int = 2) -> dict[str, str]:
    rng = random.Random(seed)
    for borough, name in list(BOROUGHS.items())[:2]:
        folder = base / name
        stops = ["100", "0100", *[f"{borough[0]}{i}" for i in range(15)]]
        _write(
            folder,
            "stops",
            "stop_id,stop_name,stop_desc,stop_lat,stop_lon",
            [f"{s},{borough} {s},,{i}.5,-{i}.25" for i, s in enumerate(stops)],
        )
        # The same trip ids in both feeds, on different routes.
        _write(
            folder,
            "trips",
            "trip_id,route_id",
            [f"T{n:03d},{borough[0]}{n % 4}" for n in range(90)],
        )
        _write(
            folder,
            "stop_times",
            "trip_id,arrival_time,stop_id",
            [
                f"T{rng.randrange(100):03d},{rng.choice([0, 7, 8, 23, 24]):02d}:10:00,"
                f"{rng.choice([*stops, 'gone'])}"
                for _ in range(1500)
            ],
        )
    return {borough: str(base / name) for borough, name in BOROUGHS.items()}


def rows(folder, table: str) -> list[dict]:
    """The lines of a file as dicts; an empty field is None."""
    with open(Path(folder) / f"{table}.txt", newline="") as lines:
        return [{k: v or None for k, v in line.items()} for line in csv.DictReader(lines)]


def listed_stops(folder, **tags) -> list[dict]:
    return [
        {
            "stop_id": stop["stop_id"],
            "stop_name": stop["stop_name"],
            "stop_lat": float(stop["stop_lat"]),
            "stop_lon": float(stop["stop_lon"]),
            **tags,
        }
        for stop in rows(folder, "stops")
    ]


def route_arrivals(folder) -> list[dict]:
    """Every stop time with whatever its trip and route say."""
    trips = {trip["trip_id"]: trip for trip in rows(folder, "trips")}
    routes = {route["route_id"]: route for route in rows(folder, "routes")}
    found = []
    for time in rows(folder, "stop_times"):
        trip = trips.get(time["trip_id"], {})
        colour = routes.get(trip.get("route_id"), {}).get("route_color")
        direction = trip.get("direction_id")
        found.append(
            {
                "trip_id": time["trip_id"],
                "stop_id": time["stop_id"],
                "arrival_time": time["arrival_time"],
                "route_id": trip.get("route_id"),
                "direction_id": direction and int(direction),
                "shape_id": trip.get("shape_id"),
                "route_color": colour and f"#{colour.strip()}",
                "hour": int(time["arrival_time"][:2]),
            }
        )
    return found


def borough_arrivals(feeds: dict[str, str]) -> tuple[list[dict], list[dict]]:
    """Stops and arrivals of the feeds that exist; a stop time needs its own feed's trip."""
    stops, found = [], []
    for borough, folder in feeds.items():
        if not Path(folder).exists():
            continue
        stops += listed_stops(folder, borough=borough)
        routes = {trip["trip_id"]: trip["route_id"] for trip in rows(folder, "trips")}
        for time in rows(folder, "stop_times"):
            if time["trip_id"] in routes:
                found.append(
                    {
                        "trip_id": time["trip_id"],
                        "stop_id": time["stop_id"],
                        "arrival_time": time["arrival_time"],
                        "route_id": routes[time["trip_id"]],
                        "borough": borough,
                        "hour": int(time["arrival_time"][:2]),
                    }
                )
    return stops, found


def by_key(items: list[dict], *keys: str) -> dict[tuple, list[dict]]:
    """Items per key; one that lacks a part of the key is in no group."""
    groups = defaultdict(list)
    for item in items:
        key = tuple(item[name] for name in keys)
        if None not in key:
            groups[key].append(item)
    return groups


def distinct(items: list[dict], name: str) -> int:
    return len({item[name] for item in items} - {None})


def tuples(items: list[dict], columns: list[str]) -> list[tuple]:
    return sorted((tuple(item[name] for name in columns) for item in items), key=repr)
