"""Schemas of the source tables, so that no read has to infer types."""

from __future__ import annotations

# Cleaned tables as DDL, in file column order.
CLEAN = {
    "circuits": "circuitId int, circuitRef string, name string, location string, country string, lat double, lng double",
    "constructors": "constructorId int, constructorRef string, name string, nationality string",
    "constructor_results": "constructorResultsId int, raceId int, constructorId int, points int",
    "constructor_standings": (
        "constructorStandingsId int, raceId int, constructorId int, points int, position int, "
        "positionText string, wins int, is_classified boolean"
    ),
    "driver_standings": (
        "driverStandingsId int, raceId int, driverId int, points int, position int, positionText string, "
        "wins int, is_classified boolean"
    ),
    "drivers": (
        "driverId int, driverRef string, number int, code string, forename string, surname string, dob string, "
        "nationality string, full_name string, birth_year int"
    ),
    "lap_times": (
        "raceId int, driverId int, lap int, position int, time string, milliseconds bigint, lap_flag string"
    ),
    "pit_stops": (
        "raceId int, driverId int, stop int, lap int, time string, duration double, milliseconds bigint"
    ),
    "qualifying": (
        "qualifyId int, raceId int, driverId int, constructorId int, number int, position int, "
        "q1 string, q2 string, q3 string"
    ),
    "races": (
        "raceId int, year int, round int, circuitId int, name string, date string, time string, url string"
    ),
    "results": (
        "resultId int, raceId int, driverId int, constructorId int, number int, grid int, position int, "
        "positionText string, positionOrder int, points double, laps int, time string, milliseconds bigint, "
        "fastestLap int, rank int, fastestLapTime string, fastestLapSpeed double, statusId int"
    ),
    "seasons": "year int, url string",
    "status": "statusId int, status string",
}

# File names a table may have; blanks may stand for underscores.
FILE_NAMES = {
    "circuits": ["Clean_Circuits_Data.csv", "circuits.csv"],
    "constructors": ["Constructors_Clean_Data.csv", "constructors.csv"],
    "constructor_results": ["Constructor_Results_Clean.csv", "constructor_results.csv"],
    "constructor_standings": ["Constructor_Standings.csv", "constructor_standings.csv"],
    "driver_standings": ["Driver_Standings.csv", "driver_standings.csv"],
    "drivers": ["Clean_Drivers_Data.csv", "drivers.csv"],
    "lap_times": ["Lap_Times_Clean.csv", "lap_times.csv"],
    "pit_stops": ["Cleaned_Pit_Stops.csv", "pit_stops.csv"],
    "qualifying": ["Cleaned_Qualifying_Data.csv", "qualifying.csv"],
    "races": ["Cleaned_Races.csv", "races.csv"],
    "results": ["Cleaned_Results.csv", "results.csv"],
    "seasons": ["Cleaned_Seasons.csv", "seasons.csv"],
    "status": ["Cleaned_Status.csv", "status.csv"],
}

# Raw files that are not in UTF-8. Raw files are named like the tables, in camel case or with underscores.
RAW_ENCODINGS = dict.fromkeys(
    ["circuits", "constructors", "constructor_results", "constructor_standings", "drivers", "driver_standings", "lap_times"],
    "ISO-8859-1")
