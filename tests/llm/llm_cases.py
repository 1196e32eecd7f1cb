"""Inputs shared by the operator tests."""

# texts that every text operator must take: null, empty, blank, short, odd and long
ODD_TEXTS = [None, "", " \t\n\x0b\x0c\r", "a", "Ünïcödé İstanbul ΣΊΣΥΦΟΣ ﬁn é", "x" * 30_000, "one two " * 5_000,
             "<|endoftext|>a<|startoftext|> b<|endoftext|>", "don't we'LL I'M 12 345 --- 日本語 ١٢٣   \x85x\x1cy",
             "tab\tsep\nline\r\nend", "\U0001f600 emoji \U0001f468‍\U0001f469", "a" * 500 + " " * 500 + "!" * 500]
