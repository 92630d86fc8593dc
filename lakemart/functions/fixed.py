"""Fixed values that must equal the original pipelines' values for equal results."""

# --- fixed values -----------------------------------------------------------
# English stop-word list used by the keyword tagger, one token per entry, in the
# order of the original list file (the empty string is the file's blank line).
STOPWORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your",
    "yours", "yourself", "yourselves", "he", "him", "his", "himself", "she",
    "her", "hers", "herself", "it", "its", "itself", "they", "them", "their",
    "theirs", "themselves", "what", "which", "who", "whom", "this", "that",
    "these", "those", "am", "is", "are", "was", "were", "be", "been", "being",
    "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of",
    "at", "by", "for", "with", "about", "against", "between", "into", "through",
    "during", "before", "after", "above", "below", "to", "from", "up", "down",
    "in", "out", "on", "off", "over", "under", "again", "further", "then",
    "once", "here", "there", "when", "where", "why", "how", "all", "any", "both",
    "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not",
    "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will",
    "just", "don", "should", "now", "", ".", '"', "'", "-", ",", ":", ";", "-",
    "=", "+", "_", "?", "!", "@", "#", "%", "^", "&", "*", "|", "\\", "/",
]

# Movie ids dropped before the mart is built (bad rows of the metadata file).
DENY_IMDB_IDS = ["0", "tt0113002", "tt2423504", "tt2622826"]

# Token separators of the tagger as written in its code: a punctuation mark
# counts only when a blank follows it.
TOKEN_SPLIT_STRICT = r": |! |\? |, | |\. "
# Separators as the task statement words them: whitespace , : ! ?
# (whitespace spelled out as Java's \s class, so every regex engine agrees)
TOKEN_SPLIT_SPEC = r"[ \t\n\x0B\f\r,:!?]+"

# Grade report wording and threshold.
PASSING_GRADE = 50.0
GRADE_PASSED = " has passed the subject with avg grade of "
GRADE_FAILED = " has failed the subject with avg grade of "

# Team name prefix.
TEAM_PREFIX = "Team: "
# --- end of fixed values -----------------------------------------------------
