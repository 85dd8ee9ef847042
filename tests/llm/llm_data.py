"""Rows shared by the tests of this folder."""

#: Extra columns whose names are used inside the operators.
CLASH = {"kept": 1, "score": 2.0, "row": "r", "x": 3, "n": 4, "h": "h", "id": 9, "prediction": 0.5, "features": "f", "word": "w"}
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def edge_documents():
    """Nulls in every column, empty, blank and very long texts, repeated rows, ties."""
    base = " ".join(f"word{i} and" for i in range(60))
    return [
        (1, base, "en", "a", 5), (1, base, "en", "a", 5), (2, base, "en", "a", None), (3, base + " tail", "en", None, 3),
        (4, None, "en", "a", 0), (5, "", None, "b", 0), (6, " \n\t ", "de", "b", 4), (7, "one two", "de", "b", 7),
        (8, "one two", "de", "c", 7), (9, "1 2 3 !!! $$$", None, "c", 9), (10, "x" * 300_000, "fr", "c", 1),
        (11, "long line again " * 30_000, "fr", "c", 1), (12, "日本語 テキスト 😀 ▁ é ﬁ\r\n\x00 <s>", "fr", "\U0001F600", 1),
        (None, base, "en", "\uffff", 1), (13, "You are an idiot and a moron, you 1d.i0t!", "en", "a", 1),
    ]
