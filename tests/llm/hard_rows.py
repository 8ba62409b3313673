"""Awkward documents: (doc_id, text, lang, source, n_chars)."""

#: Null, empty, white space, ties, repeated rows, odd characters, one word, a null id.
HARD = [
    (1, None, "en", "a", 0), (2, "", None, None, 0), (3, " \t\n\x0b\x0c\r ", "en", None, 6), (4, "one", "en", "a", 3),
    (5, "The quick brown fox jumps over the lazy dog again and again", "en", "a", 59),
    (5, "The quick brown fox jumps over the lazy dog again and again", "en", "a", 59),
    (6, "the QUICK brown fox jumps over the lazy dog again and again", "de", "b", 59),
    (None, "The quick brown fox jumps over the lazy dog again and again", None, "a", 59),
    (7, "Ünï\u00a0cödé \U0001F600 Σίσυφος <|endoftext|> it's ﬁne I'LL e\u0301\u200b", "fr", "ß", 40),
    (8, "x " * 30000, "fr", "b", 60000), (9, "### $$$ %%%\n### $$$ %%%\n&&& ||| <<< >>>", "en", "\U00010000", 41),
    (10, "Released under the M1T License. mit license mit license, Apache-License", "en", "\uffff", 70),
    (11, "½ 123 ² ___ 456", "es", "b", 15), (-12, "y" * 100_000, "es", None, 100_000),
]
