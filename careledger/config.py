"""Business configuration: names that appear in the source data.

These are data, not logic (SURVEY X4); every query takes them from here so a
deployment with other POS profiles or item groups only edits this module.
"""

from __future__ import annotations

from datetime import date

# --- Fixed values (must equal the source system's names for right results) ---
STORE_POS_PROFILE = "Vennala POS"
STORE_LABEL_LONG = "Vennala Store"  # channel label of the sales-by-channel charts
STORE_LABEL = "Store"
TRUCK_LABEL = "Truck"

GROOMING_SERVICES = "Grooming Services"
TRAVEL_SERVICES = "Travel Services"
GROOMING_GROUPS = ("Grooming Services", "Travel Services")
ADD_ON_MARKER = "ADD"  # item codes containing this are grooming add-ons

CATEGORY_GROOMING = "Grooming & Travel"
CATEGORY_PRODUCT = "Product"

# Food item groups and their short labels, in this order.
FOOD_TYPES = (
    ("Dogs – Dry Food", "Dog Dry"),
    ("Dogs – Wet Food", "Dog Wet"),
    ("Dogs – Treats", "Dog Treats"),
    ("Cats – Dry Food", "Cat Dry"),
    ("Cats – Wet Food", "Cat Wet"),
    ("Cats – Treats", "Cat Treats"),
    ("Cats – Creamy Treats", "Cat Creamy Treats"),
    ("Pet Food", "Pet Food"),
)
FOOD_GROUPS = tuple(g for g, _ in FOOD_TYPES)

# Call-log status buckets (compared after upper-casing).
CALL_STATUS_BUCKETS = (
    ("answered", ("ANSWER", "ANSWERED", "COMPLETED")),
    ("missed", ("MISSED",)),
    ("busy", ("BUSY",)),
    ("failed", ("FAILED",)),
    ("cancelled", ("CANCEL", "CANCELLED")),
    ("unavailable", ("CHANUNAVAIL", "UNAVAILABLE")),
)

# Queue thresholds in days.
DORMANT_DAYS = 45
LOST_DAYS = 90
RESUPPLY_DAYS = 30
ROLLING_DAYS = 30  # the window is [d - 30, d]: 31 days inclusive
MAX_COHORT_MONTHS = 36
# --- end of fixed values ---

# Fixed test date of the fixtures (FIXTURES.md).
DEFAULT_AS_OF = date(2001, 7, 20)
