"""Group-member filter.

Facts keep the rows whose id belongs to a group with one of the given
reporting codes.  Written as a semi join: no id list is collected to the
driver, and the member ids are reduced to distinct values before they are
shuffled or broadcast (AQE broadcasts them when the measured size allows).
They are stored first: AQE splits the facts of a hot id only where neither side
of the join is an aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import MemberFilter
from ..session import materialize


def member_ids(members: DataFrame, groups: DataFrame, spec: MemberFilter) -> DataFrame:
    chosen = (groups.where(F.col(spec.reporting_col).isin(*spec.codes))
              .select(F.col(spec.groups_key).alias("_g")))
    return (members.select(F.col(spec.members_key).alias("_g"), F.col(spec.member_id).alias("_id"))
            .join(chosen, "_g", "left_semi")
            .select("_id").where(F.col("_id").isNotNull()).distinct())


def filter_members(facts: DataFrame, fact_id: str, members: DataFrame, groups: DataFrame,
                   spec: MemberFilter) -> DataFrame:
    """Facts whose ``fact_id`` is a member id (NULL ids never match)."""
    ids = materialize(member_ids(members, groups, spec), "member-ids")
    return facts.join(ids, facts[fact_id] == ids["_id"], "left_semi")
