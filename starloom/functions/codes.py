"""Code tables. All of them are fixed values: aliases are matched on stripped lower case."""

REGIONS = {
    "east": "EAST", "e": "EAST", "ea": "EAST",
    "west": "WEST", "w": "WEST", "we": "WEST",
    "north": "NORTH", "n": "NORTH", "no": "NORTH",
    "south": "SOUTH", "s": "SOUTH", "so": "SOUTH",
}

MARITAL_STATUSES = {
    "single": "Single", "s": "Single", "unmarried": "Single",
    "married": "Married", "m": "Married", "wed": "Married",
    "divorced": "Divorced", "d": "Divorced", "div": "Divorced",
    "widowed": "Widowed", "w": "Widowed", "widow": "Widowed",
}

GENDERS = {"male": "Male", "m": "Male", "female": "Female", "f": "Female"}

TERMS = {
    "monthly": "Monthly", "month": "Monthly", "mo": "Monthly",
    "quarterly": "Quarterly", "quarter": "Quarterly", "qtr": "Quarterly", "q": "Quarterly",
    "annual": "Annual", "annually": "Annual", "yearly": "Annual", "year": "Annual",
    "yr": "Annual",
}

# Installments a year; any other term counts as one.
INSTALLMENTS = {"Monthly": 12, "Quarterly": 4, "Annual": 1}
DEFAULT_INSTALLMENTS = 1

LATE_FEE_RATE = "0.02"
