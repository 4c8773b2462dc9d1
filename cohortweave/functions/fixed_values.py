"""Published medical code lists and study constants, stated as they are."""

# Clinical codes, place-of-service codes and day limits of the studies.

# deliveries
DELIVERY_ICD_FIRST = ["Z37", "Z38", "O80", "O81", "O82", "O83", "O84"]
DELIVERY_DRG = [
    "540", "541", "542", "560", "768", "783", "784", "785", "786", "787", "788",
    "796", "797", "798", "805", "806", "807",
]
DELIVERY_ICD_COMPLICATION_RANGE = ("O", 60, 77)
SINGLETON_O = ["O80", "O81", "O82", "O83"]
MULTIPLE_O = ["O84"]
SINGLETON_Z = ["Z37.0", "Z37.1", "Z38.0", "Z38.1", "Z38.2"]
MULTIPLE_Z = [
    "Z37.2", "Z37.3", "Z37.4", "Z37.5", "Z37.6", "Z37.7", "Z37.8",
    "Z38.3", "Z38.4", "Z38.5", "Z38.6", "Z38.7", "Z38.8",
]
CHILDBIRTH_TEXTS = ["in childbirth", "complicating childbirth"]
DELIVERY_TEXTS = ["delivery"]
EPISODE_GAP_DAYS = 140

# weight status
OBESE_DIAGNOSES = ["E66.01", "E66.09", "E66.1", "E66.2", "E66.8", "E66.9"]
OVERWEIGHT_DIAGNOSES = ["E66.3"]
OBESE_BMI = ("Z68.", [*range(30, 46), 54])
OVERWEIGHT_BMI = ("Z68.", [*range(25, 30), 53])
NORMAL_BMI = ("Z68.", [*range(20, 25), 52])
UNDERWEIGHT_BMI = ["Z68.51"]
LOW_ADULT_BMI = ["Z68.1"]

# long-term care
SNF_PLACE = ["31"]
NURSING_HOME_PLACES = ["32", "33", "13"]
DAY_CARE_PROCEDURES = [
    "55100", "S5100", "S5101", "S5102", "S5103", "S5105",
    "A0080", "T2001", "T2002", "T2003", "T2004", "T2005", "T2007",
]
HOME_CARE_PROCEDURES = [
    "S5130", "T1019", "T1020", "S5125", "S5126", "S9122", "T1001", "T1030", "S9123", "T1002", "T1031",
    "S9124", "T1003", "S9129", "S9131", "S9128", "S9127", "S5165", "T1028",
]
HOME_CARE_REVENUE = ["023"]
PROCEDURE_CODING_SYSTEM = "CP"
DEATH_PATTERNS = ["%death%", "%dece%"]


def numbered(prefix_and_numbers: tuple[str, list[int]]) -> list[str]:
    prefix, numbers = prefix_and_numbers
    return [f"{prefix}{n}" for n in numbers]


WEIGHT_FAMILIES = {
    "obese_e66": OBESE_DIAGNOSES,
    "ovrwgt_e66": OVERWEIGHT_DIAGNOSES,
    "obese_bmi": numbered(OBESE_BMI),
    "ovrwgt_bmi": numbered(OVERWEIGHT_BMI),
    "normwgt_bmi": [*numbered(NORMAL_BMI), *LOW_ADULT_BMI],
    "undrwgt_bmi": UNDERWEIGHT_BMI,
}

DELIVERY_FAMILIES = {
    "singleton_o": (SINGLETON_O, 3),
    "multiple_o": (MULTIPLE_O, 3),
    "singleton_z": (SINGLETON_Z, 5),
    "multiple_z": (MULTIPLE_Z, 5),
}
