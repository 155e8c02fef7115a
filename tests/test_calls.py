"""Call table on in-line rows: every call type, two flags at once, missing
dialled number, a 2016 call, a call without a parts-call id, two branch
names for one branch number, and a detail row of the excluded group."""

from datetime import datetime

from callcredit.plans.calls import build_calls

MEET = ("MeetingId bigint, CustomerNo string, CustomerName string, CallerId string, ContactName string, "
        "Objective string, PartsDocumentNumber string, DialedNumber string, ActivityTypeId int, "
        "CallStart timestamp_ntz, EnterDateTime timestamp_ntz, EnterXUId bigint, PartsCallId bigint")
DET = ("MeetingId bigint, IsAfterhours int, IsService int, IsUsedRestored int, IsAgwest int, BranchNo string, "
       "Notes string, PhoneNumber string")
T = datetime(2019, 5, 1, 9)


def _meeting(mid, dialed="555", activity=1, start=T, parts_call=1):
    return (mid, f" C{mid} ", f"Cust {mid}", "caller", "infl", "obj", "doc", dialed, activity, start, T, 7,
            parts_call)


def test_call_types_and_joins(spark):
    meetings = spark.createDataFrame([
        _meeting(1, activity=2),            # walk in, even with flags set
        _meeting(2),                        # afterhours + service: first test wins
        _meeting(3),                        # service
        _meeting(4),                        # used/restored
        _meeting(5, dialed=None),           # direct call
        _meeting(6),                        # queue call
        _meeting(7, start=datetime(2016, 12, 31, 23)),   # before 2017: dropped
        _meeting(8, parts_call=None),       # no parts-call id: dropped
        _meeting(9),                        # its detail row belongs to the excluded group
    ], MEET)
    details = spark.createDataFrame([
        (1, 1, 1, 0, 0, "B1", "n1", None),
        (2, 1, 1, 0, 0, "B1", "n2", "999"),
        (3, 0, 1, 0, 0, "B2", None, None),
        (4, 0, 0, 1, 0, "B9", "n4", None),
        (9, 1, 0, 0, 1, "B1", "n9", None),
    ], DET)
    x_user = spark.createDataFrame([(7, "ann", 1)], "UserId bigint, LoginName string, DomainId int")
    people = spark.createDataFrame([("ann", 1, "Ann", "Lee", "E1"), ("ann", 2, "Other", "Domain", "E2")],
                                   "LoginName string, DomainId int, FirstName string, LastName string, SAPID string")
    staff = spark.createDataFrame([("E1", "Branch North")], "EmployeeNumber string, PersSubText string")
    phones = spark.createDataFrame([("555", "B1", "Zeta"), ("777", "B2", "Beta"), ("778", "B2", "Alpha")],
                                   "PhoneNumber string, BranchNo string, BranchName string")
    out = {r.MeetingId: r for r in build_calls(meetings, x_user, people, staff, phones, details).collect()}
    assert sorted(out) == [1, 2, 3, 4, 5, 6, 9]
    assert [out[i].CallType for i in (1, 2, 3, 4, 5, 6, 9)] == [
        "Walk In", "Afterhours", "Service", "Used/Restored", "Direct Call", "Queue Call", "Queue Call"]
    # contact on the two-key join (login and domain), branch from the employee record
    assert out[1].Contact == "Ann Lee" and out[1].Branch == "Branch North"
    assert out[1].CustomerNo == "C1"
    # caller id from the detail's phone when present
    assert out[2].CallerId == "999" and out[1].CallerId == "caller"
    # dialled branch from the dialled number, else the detail's branch and its first name
    assert (out[1].DialedBranchNo, out[1].DialedBranchName) == ("B1", "Zeta")
    assert (out[5].DialedBranchNo, out[5].DialedBranchName) == ("", "")
    # the excluded group's detail row is not joined: no notes, no flags
    assert out[9].Notes == "" and out[3].Notes == ""


def test_detail_branch_first_name(spark):
    meetings = spark.createDataFrame([_meeting(1, dialed="000")], MEET)
    details = spark.createDataFrame([(1, 0, 0, 0, 0, "B2", "x", None)], DET)
    empty_users = spark.createDataFrame([], "UserId bigint, LoginName string, DomainId int")
    empty_people = spark.createDataFrame([], "LoginName string, DomainId int, FirstName string, LastName string, "
                                             "SAPID string")
    empty_staff = spark.createDataFrame([], "EmployeeNumber string, PersSubText string")
    phones = spark.createDataFrame([("777", "B2", "Beta"), ("778", "B2", "Alpha")],
                                   "PhoneNumber string, BranchNo string, BranchName string")
    r = build_calls(meetings, empty_users, empty_people, empty_staff, phones, details).first()
    # dialled number unknown: the detail's branch, named by its first name in order
    assert (r.DialedBranchNo, r.DialedBranchName) == ("B2", "Alpha")
    assert r.Contact is None and r.CallType == "Queue Call"


def test_first_per_key_orders_missing_names_first(spark):
    from callcredit.plans.calls import first_per_key
    df = spark.createDataFrame([("B1", "Zeta"), ("B1", None), ("B2", "Beta"), ("B2", "Alpha")],
                               "BranchNo string, BranchName string")
    got = {r.BranchNo: r.BranchName for r in first_per_key(df, "BranchNo", "BranchName").collect()}
    assert got == {"B1": None, "B2": "Alpha"}
