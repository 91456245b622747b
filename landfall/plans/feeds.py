"""The five feeds (C1-C5) as data.

Fixed values: the column names each feed's rules read and the output order of
the two closed feeds are the data contract of the landing files and must stay
as they are. Their producers write no line break inside a field, so big files
split; a file with such a break fails its load and needs
``with_options(multi_line=True)``. Prefixes and target names are this library's defaults; a
deployment passes its own with ``FeedSpec.with_options(prefix=..., target=...)``.
"""

from landfall.plans.spec import (
    FILE_NAME,
    LOAD_STAMP,
    DateText,
    Digits,
    FeedSpec,
    FileName,
    LoadStamp,
    Rename,
    SplitName,
    TimeText,
    check_targets,
)

# Open feed; lenient birth date, phone digits, stamp and file name last.
DEMOGRAPHICS = FeedSpec(
    name="demographics",
    prefix="patient_demographics",
    target="patient_demographics",
    multi_line=False,
    fill_missing=True,
    rules=(
        DateText("Patient DOB", strict=False),
        Digits("Patient Phone Number"),
        LoadStamp(),
        FileName(),
    ),
)

# Closed feed of twelve columns.
APPOINTMENTS = FeedSpec(
    name="appointments",
    prefix="appointments",
    target="appointments",
    multi_line=False,
    rules=(
        TimeText("Appointment Time"),
        DateText("Appointment Date"),
        SplitName("Provider Name", "Provider Last Name", "Provider First Name"),
        LoadStamp(),
        FileName(),
    ),
    output=(
        "Patient MRN", "Provider Last Name", "Provider First Name", "Department ID",
        "Department Name", "Appointment Date", "Appointment Time", "Appointment Type",
        "Appointment Description", "Appointment Status", FILE_NAME, LOAD_STAMP,
    ),
)

# Closed feed of thirteen columns.
PROVIDERS = FeedSpec(
    name="providers",
    prefix="providers",
    target="providers",
    multi_line=False,
    rules=(
        DateText("Start Date"),
        DateText("End Date"),
        SplitName("Provider Name", "Provider Last Name", "Provider First Name"),
        LoadStamp(),
        FileName(),
    ),
    output=(
        "Provider NPI", "Provider Last Name", "Provider First Name", "Degree", "Current Status",
        "Department ID", "Department Name", "Section Name", "Start Date", "End Date",
        "Specialty", FILE_NAME, LOAD_STAMP,
    ),
)

# C4: open feed with its own target.
VISITS = FeedSpec(
    name="visits",
    prefix="patient_visits",
    target="patient_visits",
    multi_line=False,
    fill_missing=True,
    rules=(
        DateText("Admit Date or Service Date"),
        LoadStamp(),
        FileName(),
    ),
)

# Open feed; one rename, skipped when the column is absent.
RX_ORDERS = FeedSpec(
    name="rx_orders",
    prefix="rx_orders",
    target="rx_orders",
    multi_line=False,
    rules=(
        Rename("pharmacyid", "Pharmacy ID"),
        DateText("Date Sent"),
        LoadStamp(),
        FileName(),
    ),
)

ALL_FEEDS = (DEMOGRAPHICS, APPOINTMENTS, PROVIDERS, VISITS, RX_ORDERS)
check_targets(ALL_FEEDS)

BY_NAME = {f.name: f for f in ALL_FEEDS}
