"""The score of a language is its share of the letters, whatever their bytes are."""

from tillsight.llm.langid import Words


def test_letters_are_characters():
    texts = ["abcd абвг", "— ’ 12", "日本 x", "", "é\U00020000"]
    w = Words([t.encode() for t in texts])
    letters = iter(w.sums(w.starts.astype(int)).tolist())
    got = [[next(letters) for _ in range(n)] for n in w.per_text]
    assert got == [[4, 4], [0, 0, 0], [2, 1], [], [2]]
