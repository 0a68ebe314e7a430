"""Rows that every operator has to bear."""

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns whose names clash with what the operators make on their way.
CLASHES = (
    "n_words long, kept boolean, fp long, text_hash long, score double, label double, ids array<int>, spans string, doc string"
)


def prose(seed: int, n: int) -> str:
    """n words, different for each seed."""
    return " ".join(f"w{(seed * 7919 + i * 104729) % 100003}" for i in range(n))


LONG = prose(5, 60_000)

EDGES = [
    (1, prose(1, 60), "en", "a", 10),
    (1, prose(1, 60), "en", "a", 10),  # the same row again
    (2, prose(1, 60), "en", "a", 10),  # its text under another id
    (3, None, "en", "a", None),
    (4, "", "en", None, 0),
    (5, " \n\t ", None, "b", 4),
    (None, prose(2, 40), "de", None, 5),
    (None, None, None, None, None),
    (6, LONG, "fr", "b", len(LONG)),
    (7, "Ünï cödé\x0b漢字 <|endoftext|> 'S it's 1st", "de", "b", 9),
    (1, prose(3, 30), "es", "b", 1),  # another text under a used id
    (8, "one two three", "en", "b", 3),
]
