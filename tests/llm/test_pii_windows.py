from corpusloom.llm import pii_crf


def added(text):
    taken = pii_crf.base_spans(text)
    return [(k, text[a:b]) for a, b, k in pii_crf.field().spans(text, taken)]


def test_spans_over_a_window_border():
    for least in (345, 355, 370, 385, 390, 398, 399, 400, 410, 730, 800):
        for shift in range(3):
            text = "v1.2 " * (least + shift - 1) + "call (555) 123-4567 now " + "v1.2 " * 60
            assert added(text) == [("phone", "(555) 123-4567")], (least, shift)


def test_each_token_counts_in_one_window():
    for n in (1, 399, 400, 401, 761, 762, 1000, 2000):
        region = [(2 * k, 2 * k + 1) for k in range(n)]
        got = [t for tokens, low, high in pii_crf.windows([region]) for t in tokens[low:high]]
        assert got == region


def test_long_tokens_are_split():
    text = "see " + "a=bcdefgh&" * 20 + "phone=555-123-4567&" + "a=bcdefgh&" * 20 + " end"
    assert ("phone", "555-123-4567") in added(text)
