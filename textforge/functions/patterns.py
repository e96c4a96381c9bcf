"""Fixed character classes and patterns, in Java regex syntax."""

# Python's \w, \d and \s are Unicode aware; Java's are ASCII only, so spell the classes out.
WORD = r"\p{L}\p{N}_"
SPACE = r"\s\x0B\x1C-\x1F\x85\p{Z}"
DIGIT = r"\p{Nd}"

TAG = r"<[^>]+>"
URL = rf"https?://[^{SPACE}]+|www\.[^{SPACE}]+|ftp://[^{SPACE}]+"
NOT_WORD_OR_SPACE = rf"[^{WORD}{SPACE}]"
WORD_RUN = rf"[{WORD}]+"
TERM_RUN = rf"[{WORD}]{{2,}}"
# Excluding a-z first decides most characters with one comparison.
SPACE_RUN = rf"[[^a-z]&&[{SPACE}]]+"
# The same characters for trimming: the ends are looked at, not the whole text.
SPACE_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# URL test of the exploratory profile.
URL_PROFILE = (
    r"http[s]?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*\\(\\),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+"
)
# Characters kept by the notebook cleaner, and counted as punctuation.
NOT_BASIC = rf"[^A-Za-z0-9{SPACE}!?.,]"
PUNCTUATION_CHARS = ".!?;\"'()[]{}-"

# Code point ranges removed as emoji. The last one is wide and also
# covers CJK and Hangul letters.
EMOJI_RANGES = (
    (0x1F600, 0x1F64F),
    (0x1F300, 0x1F5FF),
    (0x1F680, 0x1F6FF),
    (0x1F1E0, 0x1F1FF),
    (0x2702, 0x27B0),
    (0x24C2, 0x1F251),
)
# The same without letters: the wide range is cut down to its emoji blocks.
EMOJI_RANGES_NARROW = EMOJI_RANGES[:-1] + (
    (0x24C2, 0x24C2),
    (0x25A0, 0x27BF),
    (0x2B00, 0x2BFF),
    (0x1F000, 0x1F251),
    (0x1F900, 0x1FAFF),
)


def emoji_class(wide: bool = True) -> str:
    ranges = EMOJI_RANGES if wide else EMOJI_RANGES_NARROW
    return "[" + "".join(rf"\x{{{lo:X}}}-\x{{{hi:X}}}" for lo, hi in ranges) + "]"


def drop_chars(*classes: str) -> str:
    """Runs of characters in any of the classes.

    None of the classes used here holds ``a-z`` or the blank; testing those first
    decides most characters with one comparison.
    """
    return f"[[^a-z ]&&[{''.join(classes)}]]+"
