"""Settings and fixed values of the emission model."""

# Pinned run settings.
VERSION = "v1.5.0"
VARIABLES_AS_OF = "2024-05-01"
MUNICIPALITY_YEAR = 2024
MAX_DATES_PER_RANGE = 90
CLOSE_TO_POWER_CELLS = 1

# Sentinels and open interval ends.
UNKNOWN = "Unknown"
UNKNOWN_NUMBER = -99
UNKNOWN_FUEL_CODE = "UU"
FIRST_DATE = "1900-01-01"
LAST_DATE = "2999-12-31"
NO_SHORE_POWER_DISTANCE = 99
OPEN_HIGH_LIMIT = 9999999
MMSI_LIMIT = 776000000

# Fuels and engine types.
RESIDUAL = "Residual Fuel"
DISTILLATE = "Distillate Fuel"
LNG = "LNG"
METHANOL = "Methanol"
ELECTRIC = "Electric"
DIESELS = ("SSD", "MSD", "HSD")
ENGINES = ("main_engine", "aux", "boiler")
POLLUTANTS = ("bc", "ch4", "co", "co2", "n2o", "nmvoc", "nox", "pm10", "sox")
SIZE_UNITS = ("gt", "dwt", "teu", "cbm")
OPERATING_MODES = ("berth", "anchor", "maneuver", "cruise")

# Tanker classes with the long-berth power reduction.
TANKER_CLASSES = ("Gasstankskip", "Oljetanker")

# Economic-zone parts reported as Svalbard.
SVALBARD_ZONES = (
    "431ed9a6-bfcb-41b2-99fe-ef9ac0ce49df",
    "b5336246-a11e-4311-85b4-37da96598bbe",
    "5b58a87b-58f2-4bd7-954f-46741c066405",
    "5d48c1fa-2178-46ab-97af-6ba2e6e54048",
)
