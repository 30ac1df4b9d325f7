"""The settlement of a period: each table from the ones it depends on, built when it is first asked for."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborpay.operators import bonuses, elite, honor, tree, volume
from arborpay.sources.domain import Domain

#: Rates of the level fee by level, in millionths.
LEVEL_FEES = {1: 100_000, 2: 50_000, 3: 30_000, 4: 20_000, 5: 10_000, 6: 5_000}


class Settlement:
    """Tables of one period over a domain. Amounts are cents; every step can be read on its own."""

    def __init__(self, domain: Domain):
        self.d, self.ws, self.config = domain, domain.ws, domain.config
        self.spark = domain.ws.spark
        self._parts: dict[str, DataFrame] = {}

    def family(self, prefix: str, key: str, value: str, micro: bool = True) -> DataFrame:
        return self.config.frame(self.spark, prefix, key, value, micro)

    @cached_property
    def orders(self) -> DataFrame:
        return self.ws.table(self.d.of_period(), "orders")

    @cached_property
    def sponsor(self) -> DataFrame:
        return self.ws.table(tree.depths(self.ws, self.d.sponsor), "sponsor")

    @cached_property
    def placement(self) -> DataFrame:
        return self.ws.table(tree.depths(self.ws, self.d.placement), "placement")

    @cached_property
    def above(self) -> DataFrame:
        return honor.above(self.ws, self.levels)

    @cached_property
    def own(self) -> DataFrame:
        return self.ws.table(volume.own_volume(self.orders), "own")

    @cached_property
    def team(self) -> DataFrame:
        return self.ws.table(volume.team_volume(self.ws, self.sponsor, self.own), "team")

    @cached_property
    def carry(self) -> DataFrame:
        """Leg surplus that the period before left: its new leg volumes matched against each other."""
        past = volume.leg_volume(self.ws, self.placement, volume.own_volume(self.d.of_period(self.d.period - 1)))
        touch = F.least("pv_1l", "pv_2l")
        return self.ws.table(past.select("user_id", (F.col("pv_1l") - touch).alias("surplus_1l"), (F.col("pv_2l") - touch).alias("surplus_2l")), "carry")

    @cached_property
    def month(self) -> DataFrame:
        active = int(self.config.number("monthActivePV") * 100)
        return volume.monthly(self.ws, self.orders, self.sponsor, self.placement, self.d.members, self.carry, active, self.team)

    @cached_property
    def elite_net(self) -> DataFrame:
        return elite.elite_net(self.ws, self.team)

    @cached_property
    def level_net(self) -> DataFrame:
        return elite.level_net(self.ws, self.team)

    @cached_property
    def levels(self) -> DataFrame:
        return elite.elite_level(self.ws, self.level_net)

    @cached_property
    def ranks(self) -> DataFrame:
        return elite.rank_snapshot(self.ws, self.sponsor, self.own)

    @cached_property
    def ranks_before(self) -> DataFrame:
        return elite.rank_snapshot(self.ws, self.sponsor, volume.own_volume(self.d.of_period(self.d.period - 1)))

    @cached_property
    def layer_sources(self) -> DataFrame:
        return honor.layer_sources(self.ws, self.levels, self.above)

    @cached_property
    def _honor(self) -> tuple[DataFrame, DataFrame]:
        limits = self.family("leadershipLimit", "member_level", "honor_limit", micro=False)
        return honor.honor_levels(self.ws, self.levels, self.layer_sources, self.d.members, limits, self.above)

    @property
    def honors(self) -> DataFrame:
        return self._honor[0]

    @property
    def honor_layers(self) -> DataFrame:
        return self._honor[1]

    @cached_property
    def _leadership(self) -> tuple[DataFrame, DataFrame]:
        details, paid = honor.leadership(self.ws, self.levels, self.layer_sources, self.honors, self.d.members, self.d.regions, self.month, self.family("leadershipRate", "layer", "rate"), self.above)
        return details, self.ws.table(paid, "leadership")

    @cached_property
    def match(self) -> DataFrame:
        return self.ws.table(bonuses.team_match(self.month, self.d.members, self.family("teamTouchRate", "member_level", "rate"), self.family("teamTouchCapping", "member_level", "cap", micro=False)), "match")

    def part(self, name: str) -> DataFrame:
        """One bonus, by its name in a total."""
        if name not in self._parts:
            d, c = self.d, self.config
            active = self.month.select("user_id", "is_active") if name in ("pe", "se", "crb", "eab") else None
            if name == "e":
                rows = elite.elite_bonus(self.elite_net, c.micro("eliteRate"))
            elif name == "pe":
                rows = elite.pro_elite_bonus(self.levels, active, c.micro("proEliteRate"))
            elif name == "se":
                rows = elite.super_elite_bonus(self.levels, d.members, d.regions, self.orders, active, c.micro("superEliteRate"))
            elif name == "lb":
                rows = self._leadership[1]
            elif name == "tb":
                rows = bonuses.team_bonus(self.match, c.micro("teamBisectRate"))
            elif name == "sfb":
                rows = volume.stockist_fee(self.orders, d.members, c.micro("stockistFeeRate"))
            elif name == "gpb":
                rows = honor.global_pool(self.honor_layers, d.members, self.month, self.family("globalPoolBonus", "layer", "rate"))
            elif name == "crb":
                rows = bonuses.car_room(self.ws, self.level_net, d.enrolled, self.orders, active, self.family("carRate", "layer", "rate"), self.family("roomRate", "layer", "rate"), d.period)
            elif name == "eab":
                rows = elite.achievement_bonus(self.elite_net, d.members, d.regions, self.orders, active, c.micro("eabRate")).where("bonus_eab > 0")
            else:
                raise KeyError(name)
            self._parts[name] = self.ws.table(rows, f"bonus-{name}")
        return self._parts[name]

    @property
    def parts(self) -> dict[str, DataFrame]:
        """All bonuses, by the names of a total."""
        return {n: self.part(n) for n in bonuses.TOTAL}

    @cached_property
    def points(self) -> DataFrame:
        before = volume.own_volume(self.d.of_period(self.d.period - 1)).select("user_id", F.col("pv_own").alias("total_gpv"))
        return self.ws.table(elite.performance_points(self.ws, self.d.members, self.sponsor, self.elite_net, self.month, before), "points")

    def highest_honor(self) -> DataFrame:
        return honor.highest_honor(self.d.members, self.honors, self.d.history, self.d.period)

    def total(self) -> DataFrame:
        return bonuses.total_bonus(self.parts, self.points, self.month, self.d.members)

    def inactive(self) -> DataFrame:
        return bonuses.inactive_details(self.parts, self._leadership[0], self.points, self.month, self.d.members)

    def level_fees(self) -> DataFrame:
        rates = self.spark.sql(f"SELECT * FROM VALUES {', '.join(f'({k}, {v}L)' for k, v in LEVEL_FEES.items())} AS t(level, ppm)")
        return bonuses.level_fee(self.ws, self.d.sponsor, self.orders, rates)

    def placement_settled(self) -> DataFrame:
        before = self.carry.select("user_id", F.col("surplus_1l").alias("remain_1l"), F.col("surplus_2l").alias("remain_2l"))
        now = self.ranks.select("user_id", F.col("pv_own").alias("pv"), "gpv")
        return volume.placement_settlement(self.month.where("pv_1l + pv_2l > 0").select("user_id", "pv_1l", "pv_2l"), before, now)

    def effective(self) -> DataFrame:
        state = volume.own_volume(self.d.of_period(self.d.period - 1)).select("user_id", F.lit("199601").alias("effect_month"), (F.col("pv_own") % 3000).alias("effect_pv"))
        return bonuses.effectiveness(state, self.month, "199703", int(self.config.number("effectivePV") * 100))

    def settle(self) -> dict[str, DataFrame]:
        """All result tables of the period, in the order that the rules ask for."""
        out = {"performance": self.month, "elite_level": self.levels, "rank": self.ranks, "honor": self.honors, "highest_honor": self.highest_honor(), "points": self.points}
        out |= {f"bonus_{n}": p for n, p in self.parts.items()}
        return out | {"carry": bonuses.team_carry(self.match, self.carry), "total": self.total(), "inactive": self.inactive()}


def tree_depths(s: Settlement) -> DataFrame:
    """Depths in both trees, by member."""
    first = s.sponsor.select("user_id", F.col("depth").alias("sponsor_depth"))
    return first.join(s.placement.select("user_id", F.col("depth").alias("placement_depth")).hint("merge"), "user_id", "full_outer")
