"""Small raw files with the awkward cases: two drivers share points, a double entry in one race, a pit-lane
start, a driver without date of birth, text that means missing, a team that skips seasons."""

from __future__ import annotations

import csv
import random
from pathlib import Path

from paddock.sources.schemas import RAW_ENCODINGS
from paddock.sources.tables import table_key

YEARS = [1959, 1994, 1996, 2008, 2015]
ROUNDS = 4
STATUSES = [(1, "Finished"), (2, "+1 lap"), (3, " engine"), (4, "collision"), (5, "disqualified")]


def write(folder: Path, name: str, header: list[str], rows: list) -> None:
    encoding = RAW_ENCODINGS.get(table_key(name.removesuffix(".csv")), "utf-8")
    with open(folder / name, "w", newline="", encoding=encoding) as f:
        out = csv.writer(f, lineterminator="\r\n")
        out.writerow(header)
        out.writerows(rows)


def build(folder: Path) -> dict[str, list]:
    """Write all thirteen files; return the race entries for brute-force checks."""
    rng = random.Random(11)
    teams = {d: 1 + (d - 1) // 2 for d in range(1, 9)}
    write(folder, "circuits.csv", ["circuitId", "circuitRef", "name", "location", "country", "lat", "lng", "alt", "url"],
          [(1, "a ", "Autódromo A", "X", "brazil", -23.7, -46.7, "", "u"), (2, "b", "B", "Y", "UNITED KINGDOM", 52.1, -1.0, 3, "u"),
           (2, "b", "B", "Y", "UNITED KINGDOM", 52.1, -1.0, 3, "u"), (3, "c", "Unused", "Z", "italy", 45.6, 9.3, 1, "u")])
    write(folder, "constructors.csv", ["constructorId", "constructorRef", "name", "nationality", "url", ""],
          [(t, f"team{t}", f" Team {t}", "great british", "u", "") for t in range(1, 5)])
    write(folder, "constructorResults.csv", ["constructorResultsId", "raceId", "constructorId", "points", "status"],
          [(1, 1, 1, 14.5, "NULL"), (2, 1, 2, 3.0, "D")])
    write(folder, "constructorStandings.csv", ["constructorStandingsId", "raceId", "constructorId", "points", "position",
                                                "positionText", "wins", ""],
          [(1, 1, 1, 14.5, 1, "1", 1, ""), (2, 1, 2, 3.0, 2, "E", 0, "")])
    write(folder, "driverStandings.csv", ["driverStandingsId", "raceId", "driverId", "points", "position",
                                           "positionText", "wins"], [(1, 1, 1, 9.0, 1, "1", 1), (2, 1, 2, 4.5, 0, "D", -1)])
    write(folder, "drivers.csv", ["driverId", "driverRef", "number", "code", "forename", "surname", "dob", "nationality", "url"],
          [(d, f"ref{d}", "" if d % 2 else 10 + d, "" if d < 3 else f"d{d} ", f" First{d}", f"Last{d} ",
            "" if d == 8 else ("1896-12-28" if d == 7 else f"0{d}/02/1960"), "german", "u") for d in range(1, 9)])
    races, results, qualifying = [], [], []
    race_id, result_id = 0, 0
    for year in YEARS:
        for rnd in range(1, ROUNDS + 1):
            race_id += 1
            races.append((race_id, year, rnd, 1 + rnd % 2, f"GP {rnd}", f"{year}-0{rnd}-15", "", "u"))
            field = [d for d in teams if not (teams[d] == 4 and year == 1996)]
            rng.shuffle(field)
            order = [(d, teams[d]) for d in field]
            if race_id == 1:
                order.append((field[0], teams[field[0]] % 4 + 1))  # one driver entered twice, by two teams
            for place, (d, team) in enumerate(order, 1):
                result_id += 1
                status = 1 if place < 4 else rng.choice([1, 2, 3, 4, 5])
                out = status >= 3
                points = {1: 9.0, 2: 6.0, 3: 4.0}.get(place, 0.0)
                results.append({
                    "resultId": result_id, "raceId": race_id, "driverId": d, "constructorId": team, "number": d,
                    "grid": 0 if place == 6 else rng.randint(1, 8), "position": "" if out else place,
                    "positionText": "R" if out else str(place), "positionOrder": place, "points": points,
                    "laps": 50 - place, "time": "", "milliseconds": "", "fastestLap": "", "rank": "",
                    "fastestLapTime": "", "fastestLapSpeed": "" if place == 5 else 200.0 + place, "statusId": status,
                    "year": year, "round": rnd,
                })
                if year > 1959:  # no qualifying is known for the race with the double entry
                    q2 = f"1:2{place % 10}.500" if place < 6 else rng.choice(["", "nan", "No Time"])
                    qualifying.append((result_id, race_id, d, team, d, place, f"1:3{place % 10}.{rng.randint(100, 999)}",
                                       q2, "59.25" if place == 1 else ""))
    write(folder, "races.csv", ["raceId", "year", "round", "circuitId", "name", "date", "time", "url"], races)
    columns = [c for c in results[0] if c not in ("year", "round")]
    write(folder, "results.csv", columns, [[r[c] for c in columns] for r in results])
    write(folder, "qualifying.csv", ["qualifyId", "raceId", "driverId", "constructorId", "number", "position", "q1", "q2", " q3 "],
          qualifying)
    pits, laps = [], []
    for r in (r for r in results if r["year"] == 2015):
        for stop, lap in enumerate(sorted(rng.sample(range(2, 9), 1 + r["driverId"] % 5)), 1):
            ms = 500_000 if (stop == 2 and r["driverId"] % 2) else rng.randint(20_000, 30_000)
            pits.append((r["raceId"], r["driverId"], stop, lap, "14:05:09", f"{ms / 1000:.3f}", ms))
        for lap in range(1, 10):
            ms = rng.randint(80_000, 90_000) if lap > 1 else 59_000
            laps.append((r["raceId"], r["driverId"], lap, rng.randint(1, 8), f"{ms // 60000}:{ms % 60000 / 1000:06.3f}", ms))
    write(folder, "pitStops.csv", ["raceId", "driverId", "stop", "lap", "time", "duration", "milliseconds"], pits)
    write(folder, "lapTimes.csv", ["raceId", "driverId", "lap", "position", "time", "milliseconds"], laps + laps[:3])
    write(folder, "seasons.csv", ["year", "url"], [(y, "u") for y in YEARS] + [(YEARS[0], "u")])
    write(folder, "status.csv", ["statusId", "status"], STATUSES)
    return {"results": results, "pits": pits, "laps": laps, "qualifying": qualifying, "teams": teams}
