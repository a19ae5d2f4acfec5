"""Fixed values that results depend on.

FIXED VALUES -- these must stay exactly as written; results are compared
against them.
"""

# Fixed value: ASCII punctuation removed by basic_clean (Python's string.punctuation).
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Fixed value: the missing-value sentinel kept unchanged by basic_clean.
NULL_SENTINEL = "\\N"

# Fixed value: constant question given to comments turned into answers.
COMMENT_QUESTION = "Bemærkning"

# Separators of combine_fields, per combine type and version.
# SchemeAnswer          v0: '', '  ,'            v1: '', ' [SEP] '            v2: '[CLS] ', ' [SEP] '
# SchemeQuestionAnswer  v0: '', '  ,', '  ,'     v1: '', ' [SEP] ', ' [SEP] '  v2: '[CLS] ', ' [SEP] ', ' [SEP] '
COMBINE_TOKENS = {
    ("SchemeAnswer", 0): ("", "  ,"),
    ("SchemeAnswer", 1): ("", " [SEP] "),
    ("SchemeAnswer", 2): ("[CLS] ", " [SEP] "),
    ("SchemeQuestionAnswer", 0): ("", "  ,", "  ,"),
    ("SchemeQuestionAnswer", 1): ("", " [SEP] ", " [SEP] "),
    ("SchemeQuestionAnswer", 2): ("[CLS] ", " [SEP] ", " [SEP] "),
}

# Training-log tags and the metric series they feed.
LOG_TAGS = {
    "train/epoch": "epochs",
    "train/loss": "train_loss",
    "train/learning_rate": "lr",
    "eval/loss": "val_loss",
    "eval/accuracy": "val_acc",
    "eval/precision": "val_precision",
    "eval/recall": "val_recall",
    "eval/f1": "val_f1",
}

# Default confidence thresholds of the classifier sweep and the scorer sweep.
CLASSIFIER_THRESHOLDS = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
SCORER_THRESHOLDS = (0.4, 0.5, 0.6)

# Danish stop words (the list shipped with Spark ML's StopWordsRemover, 94 words).
DANISH_STOPWORDS = (
    "og i jeg det at en den til er som på de med han af for ikke der var mig sig men et har om vi "
    "min havde ham hun nu over da fra du ud sin dem os op man hans hvor eller hvad skal selv her "
    "alle vil blev kunne ind når være dog noget ville jo deres efter ned skulle denne end dette mit "
    "også under have dig anden hende mine alt meget sit sine vor mod disse hvis din nogle hos blive "
    "mange ad bliver hendes været thi jer sådan"
).split()

# Grammar of text that counts as a number or a date (drop_date_numeric).
NUMBER_PATTERN = r"^\s*[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"
DATE_YMD_PATTERN = r"^\s*(\d{4})[-/](\d{1,2})[-/](\d{1,2})([ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?)?\s*$"
DATE_DMY_PATTERN = r"^\s*(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})([ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?)?\s*$"

# Word and token patterns (Unicode letters and digits; Java and RE2 agree on them).
NON_WORD_CHARS = r"[^\p{L}\p{N}_\s]"
TOKEN_PATTERN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"
SPLIT_NON_ALNUM = r"[^\p{L}\p{N}]+"
# A maximal run of letters and digits that holds letters only (same tokens as
# splitting on SPLIT_NON_ALNUM and keeping the purely alphabetic pieces).
LETTER_WORD = r"(?<![\p{L}\p{N}])\p{L}+(?![\p{L}\p{N}])"
