"""Call table (B1): one row per logged call with who took it, where it was
dialled, and a call type.

Joins are all LEFT joins onto the calls, so a call is never lost; a
one-to-many dimension (several rows for one phone number or one call's
details) repeats the call, as in the published definition.  The small
dimensions are broadcast by AQE when their measured size allows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import materialize

# --- fixed values -------------------------------------------------------------
WALK_IN_ACTIVITY = 2
CALL_TYPES = ("Walk In", "Afterhours", "Service", "Used/Restored", "Direct Call", "Queue Call")
FIRST_YEAR = 2017
# --- end of fixed values ------------------------------------------------------


def call_type(activity: Column, after_hours: Column, service: Column, used: Column,
              dialed: Column) -> Column:
    """First matching test wins."""
    walk_in, afterhours, svc, used_restored, direct, queue = CALL_TYPES
    return (F.when(activity.cast("int") == WALK_IN_ACTIVITY, walk_in)
            .when(after_hours.cast("int") == 1, afterhours)
            .when(service.cast("int") == 1, svc)
            .when(used.cast("int") == 1, used_restored)
            .when(dialed.isNull(), direct)
            .otherwise(queue))


def first_per_key(df: DataFrame, key: str, order: str, cols: list[str] | None = None) -> DataFrame:
    """The first row per key by ``order`` (row_number = 1).

    Catalyst turns ``row_number() ... = 1`` into a partial group limit before
    the shuffle, so each task ships one row per key.
    """
    w = Window.partitionBy(key).orderBy(F.col(order).asc_nulls_first())
    keep = cols or df.columns
    return (df.select(*keep, F.row_number().over(w).alias("_rn"))
            .where(F.col("_rn") == 1).drop("_rn"))


def staff_dimension(x_user: DataFrame, ad_user_all: DataFrame, hr_corpdir: DataFrame) -> DataFrame:
    """Who entered a call: application user -> directory person (on login
    and domain) -> employee record.  ``UserId -> Contact, Branch``."""
    person = ad_user_all.select("LoginName", "DomainId", "FirstName", "LastName", "SAPID")
    employee = hr_corpdir.select(F.col("EmployeeNumber").alias("SAPID"), "PersSubText")
    return (x_user.select("UserId", "LoginName", "DomainId")
            .join(person, ["LoginName", "DomainId"], "left")
            .join(employee, "SAPID", "left")
            .select("UserId",
                    F.concat(F.col("FirstName"), F.lit(" "), F.col("LastName")).alias("Contact"),
                    F.col("PersSubText").alias("Branch")))


def build_calls(meetings: DataFrame, x_user: DataFrame, ad_user_all: DataFrame,
                hr_corpdir: DataFrame, branch_phone: DataFrame, details: DataFrame,
                first_year: int = FIRST_YEAR) -> DataFrame:
    """B1.

    Join order: the two large inputs first - calls and their telephony
    details, both keyed by the call id (co-located, without a shuffle, when
    stored bucketed on it) - then the small dimensions: the first name of
    the branch a detail names, who entered the call (user -> person ->
    employee, pre-joined at its own size) and the dialled branch.  All joins
    are left joins whose conditions only touch the joined-in side, so the
    order does not change the rows.
    """
    # A range on the column itself, so the scan can skip row groups
    calls = meetings.where(F.col("PartsCallId").isNotNull()
                           & (F.col("CallStart") >= F.lit(f"{first_year:04d}-01-01 00:00:00")))
    # D-20: flags may arrive as booleans; compare them as integers
    kept = (details.where(F.col("IsAgwest").cast("int") == 0)
            .select("MeetingId", "IsAfterhours", "IsService", "IsUsedRestored", "Notes",
                    F.col("PhoneNumber").alias("DetailPhone"), F.col("BranchNo").alias("DetailBranchNo")))
    # stored: its size is known to the join, which can split a hot branch
    # only when neither side is an aggregate or window
    first_name = materialize(
        first_per_key(branch_phone, "BranchNo", "BranchName", ["BranchNo", "BranchName"])
        .select(F.col("BranchNo").alias("DetailBranchNo"), F.col("BranchName").alias("DetailBranchName")),
        "branch-first-name")
    staff = staff_dimension(x_user, ad_user_all, hr_corpdir).withColumnRenamed("UserId", "EnterXUId")
    dialed = branch_phone.select(F.col("PhoneNumber").alias("DialedNumber"),
                                 F.col("BranchNo").alias("DialedBranchNo_"),
                                 F.col("BranchName").alias("DialedBranchName_"))
    out = (calls.select("MeetingId", "CustomerNo", "CustomerName", "CallerId", "ContactName", "Objective",
                        "PartsDocumentNumber", "DialedNumber", "ActivityTypeId", "CallStart", "EnterDateTime",
                        "EnterXUId")
           .join(kept, "MeetingId", "left")
           .join(first_name, "DetailBranchNo", "left")
           .join(staff, "EnterXUId", "left")
           .join(dialed, "DialedNumber", "left"))
    return out.select(
        "MeetingId",
        F.trim(F.coalesce(F.col("CustomerNo"), F.lit(""))).alias("CustomerNo"),
        "CustomerName",
        F.coalesce(F.col("DetailPhone"), F.col("CallerId")).alias("CallerId"),
        F.col("ContactName").alias("Influencer"),
        "Contact", "Branch", "Objective", "PartsDocumentNumber",
        F.coalesce(F.col("Notes"), F.lit("")).alias("Notes"),
        "DialedNumber",
        F.coalesce(F.col("DialedBranchNo_"), F.col("DetailBranchNo"), F.lit("")).alias("DialedBranchNo"),
        F.coalesce(F.col("DialedBranchName_"), F.col("DetailBranchName"), F.lit("")).alias("DialedBranchName"),
        call_type(F.col("ActivityTypeId"), F.col("IsAfterhours"), F.col("IsService"),
                  F.col("IsUsedRestored"), F.col("DialedNumber")).alias("CallType"),
        "CallStart",
        F.col("EnterDateTime").alias("CallSaved"),
    )
