"""The entity-attribute-value configuration, parsed once into (family, key, value)."""

from __future__ import annotations

from decimal import Decimal, InvalidOperation

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names that end in a key, by prefix.
FAMILIES = ("leadershipRate", "leadershipLimit", "teamTouchRate", "teamTouchCapping", "carRate", "roomRate", "globalPoolBonus", "stockistFeeRateUnity", "stockistFeeRateApp", "stockistFeeRateOtc")

# The settlement configuration in percent, as its users have it.
DEFAULTS = {
    "carRate1": ".8571", "carRate2": ".7143", "carRate3": ".5714", "carRate4": ".4286", "carRate5": ".2857", "carRate6": ".1429",
    "eabRate": "10", "effectivePV": "30", "eliteRate": "15",
    "globalPoolBonus70": "1", "globalPoolBonus80": "1", "globalPoolBonus90": "1",
    "leadershipLimit0": "0", "leadershipLimit10": "0", "leadershipLimit20": "30", "leadershipLimit30": "60", "leadershipLimit40": "90",
    "leadershipRate10": "4.5", "leadershipRate20": "4.5", "leadershipRate30": "4.5", "leadershipRate40": "3.6", "leadershipRate50": "3.6", "leadershipRate60": "3.6", "leadershipRate70": "1.8", "leadershipRate80": "1.8", "leadershipRate90": "1.8",
    "monthActivePV": "30", "proEliteRate": "15",
    "roomRate1": ".5714", "roomRate2": ".4762", "roomRate3": ".3810", "roomRate4": ".2857", "roomRate5": ".1905", "roomRate6": ".0952",
    "stockistFeeRate": "8", "superEliteRate": "10", "teamBisectRate": "24",
    "teamTouchCapping10": "0", "teamTouchCapping20": "0", "teamTouchCapping30": "0", "teamTouchCapping40": "0",
    "teamTouchRate10": "10", "teamTouchRate20": "15", "teamTouchRate30": "20", "teamTouchRate40": "20",
}


class Config:
    """Checked settings. Missing, empty, repeated or out-of-range values fail when they are read.

    ``rows`` are (name, value) pairs of one type of configuration; names are stripped of white space.
    """

    def __init__(self, rows: list[tuple[str, str | None]] | None = None):
        self.rows: dict[str, list[str | None]] = {}
        for name, value in rows if rows is not None else DEFAULTS.items():
            self.rows.setdefault(name.strip(), []).append(value)

    @classmethod
    def read(cls, table: DataFrame, kind: str = "bonus") -> "Config":
        """From a table (config_name, value, type): a settings table of some hundred rows."""
        rows = table.where(F.col("type") == kind).select("config_name", "value").limit(10_001).collect()
        if len(rows) > 10_000:
            raise ValueError("configuration: more than 10000 rows")
        return cls([(r[0], r[1]) for r in rows])

    def number(self, name: str) -> Decimal:
        values = self.rows.get(name, [])
        if len(values) != 1:
            raise ValueError(f"configuration: {name} is {'missing' if not values else 'given more than once'}")
        try:
            return Decimal(str(values[0]).strip())
        except InvalidOperation:
            raise ValueError(f"configuration: {name} is not a number: {values[0]!r}") from None

    def micro(self, name: str) -> int:
        """A rate in percent, as millionths."""
        value = self.number(name)
        if not 0 <= value <= 100:
            raise ValueError(f"configuration: {name} is out of range: {value}")
        return int(value * 10_000)

    def family(self, prefix: str, micro: bool = True) -> dict[int, int]:
        """Values of the names that start with a prefix, by the number that follows it."""
        keys = sorted(int(n[len(prefix) :]) for n in self.rows if n.startswith(prefix) and n[len(prefix) :].isdigit())
        return {k: self.micro(f"{prefix}{k}") if micro else int(self.number(f"{prefix}{k}")) for k in keys}

    def frame(self, spark: SparkSession, prefix: str, key: str, value: str, micro: bool = True) -> DataFrame:
        """A family as a DataFrame (key, value): a few literal rows."""
        rows = self.family(prefix, micro)
        if not rows:
            return spark.sql(f"SELECT CAST(NULL AS INT) AS {key}, CAST(NULL AS BIGINT) AS {value} WHERE false")
        return spark.sql(f"SELECT * FROM VALUES {', '.join(f'({k}, {v}L)' for k, v in rows.items())} AS t({key}, {value})")
