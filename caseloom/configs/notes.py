"""Extraction rules for the four kinds of records: autism notes, toddler posts, diabetes notes and logs, stroke notes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseloom.operators.clean import SLANG, expand_slang
from caseloom.operators.text import (
    LEFT, RIGHT, Captured, Choice, Number, Phrases, Polarity, Questionnaire, Symptoms, Telemetry, word)

# Phrases, patterns, word lists and spellings that decide what the notes mean.

RECORD_END = r"---\s*END OF RECORD\s*#\d+\s*---"

AGE = (rf"(\d+)\s*(?:yo{RIGHT}|years?\s+old|-?yr-old|y/o|-year-old)|{LEFT}(?:age|aged)\s*(\d+)", (1, 2))
SEX_CASES = ((word("male|boy|m"), 1), (word("female|girl|f"), 0))

JAUNDICE_YES = (r"history of neonatal jaundice|jaundice: positive|hx neonatal jaundice noted|born with jaundice|neonatal icterus documented"
                r"|jaundice\(\+\)|neonatal jaundice present|jaundice hx: yes|neonatal jaundice: yes")
JAUNDICE_NO = (r"no history of neonatal|jaundice: negative|denies neonatal jaundice|no neonatal icterus|jaundice\(-\)|no jaundice reported"
               r"|jaundice hx: no|unremarkable for jaundice|neonatal jaundice: no")
FAMILY_YES = (r"positive family history|family hx of autism spectrum disorder reported|fam hx asd: positive|diagnosed with asd"
              r"|first-degree relative|family autism history: yes|asd runs in the family|fam asd\(\+\)|significant family hx includes asd"
              r"|family history of asd: yes")
FAMILY_NO = (r"no family history|family hx of asd: negative|fam hx asd: unremarkable|no known family members|denies family history"
             r"|family hx: no asd|family autism history: no|no asd in family|fam asd\(-\)|family history of asd: no")
ASD_YES = (r"classification: yes|positive for asd|asd screen positive|positive \(score|asd likely|asd positive|asd screen pos"
           r"|positive asd screen")
ASD_NO = (r"classification: no|negative for asd|asd screen negative|negative \(score|asd unlikely|asd negative|asd screen neg"
          r"|negative asd screen")

AQ_ENDORSED = r"(?s)(?:endorsed items:|patient endorsed the following:|patient endorsed)(.*?)(?:\.|all other|remaining items)"
AQ_NONE = r"no items endorsed|did not endorse any"
AQ_ITEM_LINE = r"item {item}:[^\n]*?—\s*endorsed"

AUTISM = [
    Number("age", *AGE),
    Choice("sex", SEX_CASES),
    Polarity("jaundice", JAUNDICE_NO, JAUNDICE_YES, "jaundice", ("no ", "negative", "(-)")),
    Polarity("family_asd", FAMILY_NO, FAMILY_YES),
    Choice("label", ((ASD_YES, 1), (ASD_NO, 0)), 0),
    Questionnaire("a", 10, AQ_ENDORSED, AQ_NONE, AQ_ITEM_LINE, "aq_score"),
]
AUTISM_TYPES = {**{c: "tinyint" for c in ["sex", "jaundice", "family_asd", "label", "aq_score", *[f"a{i}" for i in range(1, 11)]]},
                "age": "smallint"}

# toddler posts: item -> (phrases that show the trait, phrases that rule it out)
QCHAT = {
    "a1": (["he completely ignores me when i call his name", "never looks at me when i call her name",
            "doesn't respond to his name at all", "i call and call but no response"],
           ["responds to his name right away", "always looks at me when i call her", "knows his name perfectly"]),
    "a2": (["zero eye contact", "never looks me in the eyes", "avoids eye contact", "won't meet my gaze"],
           ["makes great eye contact", "looks me in the eyes", "eye contact is totally fine"]),
    "a3": (["doesn't point when he wants something", "just grabs my hand to get things instead of pointing", "never points at what she wants"],
           ["points at his cup when he wants it", "points to things she wants", "always pointing to ask for things"]),
    "a4": (["never points to show me a bird or airplane", "doesn't point to share things with me", "no pointing to show interest"],
           ["points out dogs and cars to me all the time", "loves pointing at airplanes to show me", "always points to share cool stuff"]),
    "a5": (["doesn't do any pretend play", "just lines up his toys, no pretending", "won't feed his teddy bear or play pretend"],
           ["loves playing pretend with her kitchen", "feeds his stuffed animals", "great imagination, lots of pretend play"]),
    "a6": (["if i look at something across the room, he doesn't follow my gaze", "doesn't look where i look", "never tracks what i'm looking at"],
           ["always looks where i point or look", "follows my gaze across the room", "tracks what i'm looking at"]),
    "a7": (["doesn't seem to care if i'm crying", "shows no empathy when someone is hurt", "doesn't try to comfort his sister when she cries"],
           ["always brings me a toy if i'm upset", "very empathetic, comforts his brother", "gets sad when i cry and hugs me"]),
    "a8": (["still no words yet", "speech is super delayed", "only babbles, no real words", "lost the few words he had"],
           ["talking up a storm", "vocabulary is exploding", "says so many words now!"]),
    "a9": (["doesn't wave bye-bye or clap", "no waving at all", "still not clapping or waving"],
           ["waves bye-bye to everyone", "loves clapping his hands", "waves and claps all the time"]),
    "a10": (["stares blankly at the ceiling fan for hours", "zones out and stares at nothing", "gets mesmerized by spinning wheels"],
            ["doesn't really zone out", "doesn't stare blankly", "no unusual staring behaviors"]),
}
RESPONDENT = r"\(([^,()]+),\s*([^)]+)\)"


def _plain(phrases: list[str]) -> list[str]:
    for short, full in SLANG.items():
        phrases = [p.replace(short, full) for p in phrases]
    return phrases


TODDLER = [
    Number("age_months", r"(\d+)\s*month"),
    Choice("sex", ((word("son"), "m"), (word("daughter"), "f")), "m"),
    Choice("jaundice", ((r"had jaundice|jaundice as a baby", "yes"),), "no"),
    Choice("family_asd", ((r"autism runs in our family|runs in the family", "yes"),), "no"),
    Captured("completed_by", ((RESPONDENT, 1),), default="family member"),
    Captured("ethnicity", ((RESPONDENT, 2),), default="White European"),
    Phrases({item: (_plain(yes), _plain(no)) for item, (yes, no) in QCHAT.items()}),
]
QCHAT_CUT = 3


def toddler_text(text: Column) -> Column:
    return expand_slang(F.lower(text))


SYMPTOM_WORDS = {
    "polyuria": ["excessive urination", "polyuria", "frequent urination", "polyurea", "urinary freq"],
    "polydipsia": ["excessive thirst", "polydipsia", "increased thirst", "constant thirst", "polydpsia"],
    "sudden_weight_loss": ["sudden weight loss", "unexplained wt loss", "rapid weight decrease", "unintentional weight loss"],
    "weakness": ["weakness", "generalized fatigue", "feeling weak and tired", "fatigue and weakness"],
    "polyphagia": ["excessive hunger", "polyphagia", "increased appetite", "constant hunger", "polyphaiga"],
    "genital_thrush": ["genital thrush", "recurrent genital yeast", "genital candidiasis", "thrush infections"],
    "visual_blurring": ["visual blurring", "blurred vision", "blurry vision", "visual disturbance"],
    "itching": ["itching", "persistent pruritus", "skin itching", "generalized itching"],
    "irritability": ["irritability", "mood changes", "irritable mood", "increased irritability"],
    "delayed_healing": ["delayed healing", "slow wound healing", "wounds heal slowly", "poor wound healing"],
    "partial_paresis": ["partial paresis", "muscle weakness in extremities", "limb weakness", "partial paralysis"],
    "muscle_stiffness": ["muscle stiffness", "joint stiffness", "stiff muscles and joints", "musculoskeletal stiffness"],
    "alopecia": ["alopecia", "hair loss", "hair thinning", "losing hair"],
    "obesity": ["obesity", "clinically obese", "bmi > 30", "obese"],
}
SYMPTOM_CODES = {name: name.upper() for name in SYMPTOM_WORDS}
REPORTS = (r"(?s)(?:reports the following|complains of|presents with|positive findings:|reports)(.*?)"
           r"(?:denies|assessment|plan|all other)")
DENIES = r"(?s)denies(.*?)(?:assessment|plan)"
ALL_DENIED = r"denies all screened symptoms|all screened symptoms denied|all other screened symptoms denied"
TELEMETRY_SCHEMA = ("patient struct<age: int, gender: string>, "
                    "telemetry struct<symptoms_flagged: array<string>, risk_classification: string>")

DIABETES_PROSE = [
    Number("age", *AGE),
    Choice("sex", SEX_CASES),
    Choice("label", ((r"positive(?! findings)|high risk", 1), (r"negative|low risk", 0))),
    Symptoms(SYMPTOM_WORDS, REPORTS, DENIES, ALL_DENIED),
]
DIABETES_DEVICE = Telemetry(SYMPTOM_CODES, TELEMETRY_SCHEMA)
DIABETES_COLUMNS = ["age", "sex", *SYMPTOM_WORDS, "label"]
DIABETES_TYPES = {**{c: "tinyint" for c in ["sex", *SYMPTOM_WORDS, "label"]}, "age": "smallint"}

NUMBER = r"(\d+(?:\.\d+)?)"
WORK = "private|self-employed|govt_job|children|never_worked"
WORK_SPELLING = {"private": "Private", "self-employed": "Self-employed", "govt_job": "Govt_job", "children": "children",
                 "never_worked": "Never_worked"}
SMOKING_SPELLING = {"formerly smoked": "formerly smoked", "never smoked": "never smoked", "smokes": "smokes", "unknown": "Unknown"}
NOT_MARRIED = rf"never been married|never married|single/never married|not married|married: n{RIGHT}"
MARRIED = rf"currently or has been previously married|has been married|married: y{RIGHT}|{word('married')}"
NO_STROKE = r"outcome: no stroke|no stroke|no cerebrovascular event"
STROKE_YES = r"outcome: stroke|stroke occurred|stroke confirmed|acute stroke|acute ischemic stroke|dx: stroke"

STROKE = [
    Choice("gender", ((rf"{word('male|boy')}|{LEFT}m(?:,| married)", 1), (rf"{word('female|girl')}|{LEFT}f(?:,| married)", 0)), -1),
    Number("age", rf"{NUMBER}\s*(?:years?\s+of\s+age|yo{RIGHT}|years?\s+old|yr-old|y/o|-year-old)|{LEFT}(?:age|aged)\s*{NUMBER}", (1, 2), "double"),
    Polarity("ever_married", NOT_MARRIED, MARRIED),
    Captured("work_type", ((rf"(?:employment status|work|employment):\s*({WORK})", 1), (rf"works in\s+(?:the\s+)?({WORK})", 1)), WORK_SPELLING),
    Captured("residence_type", ((r"(?:resides in|lives in|residence:)\s*(?:an?\s+)?(urban|rural)", 1),), {"urban": 1, "rural": 0}, 1),
    Choice("hypertension", ((r"htn\(\+\)|documented hypertension|significant for[^\n]*hypertension|pmh:[^.\n]*htn(?!\()", 1),), 0),
    Choice("heart_disease", ((r"heart dz\(\+\)|history of heart disease|significant for[^\n]*heart disease|pmh:[^.\n]*heart dz(?!\()", 1),), 0),
    Number("avg_glucose_level", rf"glucose(?: level of| level:|:| \(avg\):)?\s*{NUMBER}", (1,), "double"),
    Number("bmi", rf"(?:bmi:?|bmi of|body mass index:?)\s*{NUMBER}", (1,), "double"),
    Captured("smoking_status", ((r"(?:smoking(?: history)?:|tobacco use:)\s*(formerly smoked|never smoked|smokes|unknown)", 1),), SMOKING_SPELLING),
    Choice("label", ((NO_STROKE, 0), (STROKE_YES, 1)), 0),
]
STROKE_TYPES = {c: "tinyint" for c in ["gender", "ever_married", "residence_type", "hypertension", "heart_disease", "label"]}
