"""Default parameters of the operators.

Everything here is a fixed value: changing one changes results.  Operators take
these as keyword defaults, so a caller can bind other vocabularies.
"""

# Sentiment lexicon.
POSITIVE_WORDS = (
    "amazing", "awesome", "best", "clear", "cohesive", "easy", "effective",
    "engaging", "enjoyable", "excellent", "fabulous", "fair", "fantastic",
    "fun", "good", "great", "helpful", "interesting", "kind", "knowledgeable",
    "love", "manageable", "organized", "outstanding", "prepared", "recommend",
    "rewarding", "solid", "succeed", "understandable", "useful", "well",
    "wonderful",
)
NEGATIVE_WORDS = (
    "awful", "bad", "boring", "brutal", "busywork", "challenging", "confusing",
    "difficult", "disorganized", "frustrating", "hard", "harsh", "hate",
    "impossible", "inconsistent", "intimidating", "messy", "overwhelming",
    "poor", "rushed", "stressful", "tedious", "tough", "unclear", "unfair",
    "unhelpful", "useless", "worst",
)
WORD_PATTERN = "[A-Za-z']+"
LABEL_CUTOFF = 0.20
SATURATION_HITS = 6  # confidence is ln(1 + hits) / ln(6), at most 1

# Aspect keywords, matched as substrings of lower-case sentences.
ASPECT_KEYWORDS = {
    "difficulty": (
        "difficult", "difficulty", "easy", "hard", "challenging", "brutal",
        "tough", "manageable",
    ),
    "workload": (
        "workload", "assignment", "assignments", "homework", "problem set",
        "weekly", "busywork", "reading", "time consuming", "time-consuming",
    ),
    "professor_personality": (
        "professor", "teacher", "instructor", "kind", "nice", "mean",
        "helpful", "caring", "rude", "funny", "engaging", "knowledgeable",
        "organized", "understanding",
    ),
    "assessments": (
        "exam", "exams", "midterm", "midterms", "final", "quiz", "quizzes",
        "project", "projects", "paper", "papers", "presentation",
        "presentations",
    ),
}
EXAM_TERMS = (
    "exam", "exams", "midterm", "midterms", "final", "quiz", "quizzes",
    "test", "tests",
)
PROJECT_TERMS = (
    "project", "projects", "paper", "papers", "presentation", "presentations",
)
ASSIGNMENT_TERMS = (
    "assignment", "assignments", "homework", "problem set", "problem sets",
)

# Review page markers.
SEASON_LINE = r"(?i)^(Spring|Summer|Fall|Winter)\s+\d{4}$"
UPDATED_LINE = r"(?i)^Updated\s+\d{1,2}/\d{1,2}/\d{2}$"
NUMERIC_LINE = r"^-?\d+(?:\.\d+)?$"
TOGGLE_LINES = ("Show more", "Show less")
PROMPT_LINES = (
    "Add your review!", "Questions", "Ask your Question!",
    "No Questions and Answers",
)
PROFESSOR_HREF = r"/course/\d+/\d+/?$"
MISSING_MARK = "—"

# Requirement pages.
COURSE_CODE = r"\b([A-Z]{2,5})\s+(\d{4})\b"
GROUP_HEADINGS = ("h2", "h3", "h4")
RULE_LABEL_CHARS = 120
CATALOG_YEAR = "current"
GROUP_TYPE = "course_block"
MATCH_TYPE = "explicit_course"

# Class loading.
PLACEHOLDER_NAMES = ("To Be Announced", "-")
UNKNOWN_MEETING = "TBA"
DEFAULT_TERM = "1262"
TERM_SEMESTERS = {
    "1": "J-Term", "2": "Spring", "3": "Summer", "4": "Fall", "8": "Fall",
}
WEEKDAYS = {
    "M": "meets_monday", "T": "meets_tuesday", "W": "meets_wednesday",
    "R": "meets_thursday", "F": "meets_friday", "S": "meets_saturday",
    "U": "meets_sunday",
}

# Model inputs.
SNAPSHOT_COLUMNS = (
    "seats_taken", "current_waitlist", "waitlist_size", "fill_ratio",
    "waitlist_ratio", "enrollment_status",
)
SECTION_MODEL_DROPS = (
    "filled_binary", "term_id", "course_id", "class_nbr", "title",
    "meetings_days", "meetings_start_time", "meetings_end_time",
)
SECTION_MODEL_DUMMIES = ("season", "subject_id", "component", "course_level")
CONTEXT_MODEL_DROPS = (
    "got_in", "waitlisted", "got_in_probability", "student_id", "seat_pressure",
    "planning_noise", "term_shock", "course_shock", "subject_shock",
)
CONTEXT_MODEL_DUMMIES = ("class_standing", "interest_area") + SECTION_MODEL_DUMMIES
FILL_THRESHOLD = 0.40
LOGISTIC_L2 = 1e-4
RIDGE_ALPHA = 25.0
LOGIT_CLIP = 1e-4
SIGMOID_CLIP = 30.0
TOP_WEIGHTS = 12
TOP_SECTIONS = 15

# Subjects of each interest area.
INTEREST_AREAS = {
    "quantitative": ("APMA", "MATH", "STAT", "ECON", "CS", "DS"),
    "engineering": ("ENGR", "CS", "ECE", "SYS", "MAE", "BME", "CE"),
    "life_sciences": ("BIOL", "CHEM", "NEUR", "PSYC", "PHYS"),
    "humanities": ("ENWR", "ENGL", "HIST", "PHIL", "RELG", "CLAS"),
    "social_sciences": ("ECON", "PLCP", "SOC", "ANTH", "PSYC", "GSAS"),
    "languages": ("SPAN", "FREN", "GERM", "ITAL", "ARAB", "CHIN"),
}
