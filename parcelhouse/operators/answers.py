"""Questionnaire columns and participant summaries."""

from pyspark.sql import DataFrame, functions as F

from parcelhouse.functions import bare_code
from parcelhouse.operators.profile import numeric_columns, text_columns

# Column groups; the spelling is that of the questionnaire export.
COLUMN_GROUPS = {
    "demographics": [
        "Gender", "Age", "DominantHand", "Weight (kg)", "Height (cm)", "Gender Indentity",
        "Sexual Orientation", "Country of Birth", "Marital Status", "Number of Children",
    ],
    "mental_health": [
        "OASIS", "PCL-5", "PHQ9", "GAD7", "Depression", "Anxiety", "AttentionDisorders",
        "SubjectiveHappiness", "SWLS",
    ],
    "personality": [
        "B5 Extraversion", "B5 Agreeableness", "B5 Coscientioness", "B5 EmotionalStability",
        "B5 Openness",
    ],
    "lifestyle": [
        "HoobyTime", "TimesTrainingPerWeek", "Caffeine", "Water", "SugarBeverages", "Alcohol",
        "Smoking", "Canabis", "ScreenTime", "PSQI",
    ],
    "socioeconomic": ["Education", "WorkStatus", "Salary", "PsychometricScore"],
}
# Columns coerced to numbers, and columns that are no features.
COERCED = COLUMN_GROUPS["mental_health"] + ["Age", "Weight (kg)", "Height (cm)"]
NOT_NUMERIC_FEATURES = ("UID", "EpigeneticScore", "AdjustedEpigeneticScore")
NOT_TEXT_FEATURES = ("Subject Code", "UID", "Questionnaire", "LAB")
# Expected ranges of questionnaire scales and diffusion parameters.
SCALE_RANGES = {
    "PHQ9": (0, 27), "GAD7": (0, 21), "OASIS": (0, 20), "PCL-5": (0, 80), "PSQI": (0, 21),
    "Age": (18, 100),
}
PARAMETER_RANGES = {
    "FA": (0, 1), "ICVF": (0, 1), "ISOVF": (0, 1), "OD": (0, 1), "MD": (0, 0.005),
}


def column_groups(columns, groups=None) -> dict:
    """The groups reduced to existing columns; empty groups are left out."""
    found = {
        name: [c for c in wanted if c in columns]
        for name, wanted in (groups or COLUMN_GROUPS).items()
    }
    return {name: present for name, present in found.items() if present}


def numeric_features(df: DataFrame) -> list:
    return numeric_columns(df, NOT_NUMERIC_FEATURES)


def text_features(df: DataFrame) -> list:
    return text_columns(df, NOT_TEXT_FEATURES)


def participant_summaries(df: DataFrame, ids=("Subject Code",), groups=None, chosen=None):
    """Per row: category -> {feature: value}, without nulls and empty categories."""
    available = column_groups(df.columns, groups)
    wanted = [g for g in (chosen or available) if g in available]

    def category(columns):
        cells = F.create_map(
            *[x for c in columns for x in (F.lit(c), F.col(f"`{c}`").cast("string"))]
        )
        return F.map_filter(cells, lambda _, v: v.isNotNull())

    if not wanted:
        summary = F.create_map().cast("map<string,map<string,string>>")
    else:
        summary = F.map_filter(
            F.create_map(*[x for g in wanted for x in (F.lit(g), category(available[g]))]),
            lambda _, m: F.size(m) > 0,
        )
    return df.select(*[f"`{c}`" for c in ids], summary.alias("summary"))


def participant_summary(df, subject: str, on="Subject Code", groups=None, chosen=None):
    """Summary of one participant; several rows of a subject all appear."""
    rows = df.where(F.col(f"`{on}`") == bare_code(F.lit(subject)))
    return participant_summaries(rows, (on,), groups, chosen)
