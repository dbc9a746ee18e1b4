"""Values the results depend on, as the source workloads state them.

Fixed values: codes, labels, patterns and thresholds that must equal the
source's for the same answers, listed per workload in the order the source
uses them. (Grade labels, strand subjects and campaign regexes live next to
the functions that use them, under the same kind of comment:
``functions.mapping`` and ``functions.text``.)
"""

# Organisation hierarchy types.
ORG_TYPE_TOP = 2
ORG_TYPE_DISTRICT = 0
ORG_TYPE_SCHOOL = 1

# Activity-score rows.
W1_PRODUCT = "Spanish"
W1_SKILL_EXCLUDED = "%assessment%"
W1_BRANCH = "Main"
W1_STRAND = 26
W1_STRAND_ENUM = "%Spanish%"
W1_NAME_EXCLUDED = "%review%"

# Lesson-state filters.
STATE_EXCLUDED = "%Skip%"
REASON_EXCLUDED = "%Skip%"
REASON_ALTERNATE = "SatisfiedByAlternateLesson"

# Lesson summary.
W2_PRODUCT = "ILE"
W2_PASS_THRESHOLD = 0.70
W2_ACHIEVED = "StudentAchievement"
SUBJECT_LITERACY = "Literacy"
SUBJECT_LANGUAGE = "Language"
SUBJECT_GRAMMAR = "Grammar"

# Usage and progress.
W3_SCHOOL = "School"
W3_PRODUCT_TAG = "ILE"
AREA_READING = "Reading"
AREA_VOCABULARY = "Vocabulary"
AREA_GRAMMAR = "Grammar"
SECONDS_PER_MINUTE = 60.0

# Campaign revenue.
W4_STATUS = "approved"
W4_CENTS_PER_UNIT = 100.0

# Budget forecast.
W5_EXCLUDED_KIND = "Addition"

# Record access.
MISSING_USER_NAME = ""
MISSING_PARENT_TEXT = "null"
