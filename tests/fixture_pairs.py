"""Small pairs from a made-up freight office: composite key, wider side, missing and hot keys."""

from dataclasses import dataclass

TOURS_PLANNED = [
    ("north", "rail", 12, 340, 7), ("north", "road", 4, 95, 3), ("south", "rail", 9, 410, 8),
    ("south", "road", 6, 120, 2), ("harbor", "ship", 2, 900, 31), ("airfield", "road", 3, 44, 1),
    ("depot 9", "road", 5, 61, 2),
]
TOURS_DRIVEN = [
    ("north", "rail", 12, 338, 0, 15, 2, 70), ("north", "road", 5, 95, 1, 4, 1, 22),
    ("south", "rail", 9, 410, 0, 11, 2, 84), ("south", "road", 6, 118, 0, 9, 1, 31),
    ("harbor", "ship", 2, 900, 3, 0, 5, 190), ("harbor", "rail", 1, 77, 0, 6, 1, 18),
    ("quarry", "road", 8, 260, 0, 19, 3, 55), ("", "road", 1, 10, 0, 1, 1, 9),
]


@dataclass
class Fixture:
    reference: list
    reference_names: str
    delivered: list
    delivered_names: str
    keys: str
    common: list
    delivered_only: list
    reference_only: list
    counts: tuple  # both, delivered only, reference only
    percents: tuple

    def frames(self, spark):
        return (
            spark.createDataFrame(self.reference, self.reference_names),
            spark.createDataFrame(self.delivered, self.delivered_names),
        )


def _texts(*names):
    return ", ".join(f"{name} string" for name in names)


def fixtures():
    shared = "Depot string, Mode string, Stops int, Crates int"
    tours = Fixture(
        TOURS_PLANNED, shared + ", Fuel int",
        TOURS_DRIVEN, shared + ", Returned int, Tolls int, Crew int, Minutes int",
        "Depot,Mode",
        ["depot", "mode", "stops", "crates"], ["returned", "tolls", "crew", "minutes"], ["fuel"],
        (5, 3, 2), (62.5, 37.5),
    )
    # Parcels by label: every third label was scanned, and one in four scans is of a foreign label.
    parcels = Fixture(
        [(f"L-{i}", f"zone {i % 4}", "booked") for i in range(30)],
        _texts("label", "zone", "state"),
        [(f"L-{i}" if i % 12 else f"X-{i}", f"zone {i % 4}", "gate 1", "08:00") for i in range(0, 30, 3)],
        _texts("label", "zone", "gate", "scanned"),
        "label",
        ["label", "zone"], ["gate", "scanned"], ["state"],
        (7, 3, 23), (70.0, 30.0),
    )
    # Drivers: the delivered list is wider, in another case and order, and shifted by a third.
    drivers = Fixture(
        [(i, f"driver{i}", i % 2 == 0) for i in range(9)],
        "STAFF_NO int, NICK string, NIGHTS boolean",
        [(f"driver{i}", i, "B", i % 2 == 0, 2000 + i) for i in range(3, 12)],
        "Nick string, Staff_No int, Licence string, Nights boolean, Since int",
        "staff_no",
        ["nick", "staff_no", "nights"], ["licence", "since"], [],
        (6, 3, 3), (66.67, 33.33),
    )
    # One truck sends all readings: the key alone is hot, with the sensor it is unique.
    readings = [("truck 5", f"sensor {i}", str(i * i)) for i in range(36)]
    names = _texts("Truck", "Sensor", "Reading")
    lowered = ["truck", "sensor", "reading"]
    hot = Fixture(
        readings, names, readings, names, "truck", lowered, [], [], (1, 0, 0), (100.0, 0.0)
    )
    hot_two_keys = Fixture(
        readings, names, readings, names, "truck, sensor", lowered, [], [], (36, 0, 0), (100.0, 0.0)
    )
    return {
        "tours": tours, "parcels": parcels, "drivers": drivers, "hot": hot, "hot_two_keys": hot_two_keys,
    }
