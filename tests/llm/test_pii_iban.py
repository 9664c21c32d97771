from holdfast.llm import pii


def ibans(text):
    return [text[start:end] for kind, start, end, _ in pii.find(text) if kind == "iban"]


def test_words_after_an_iban_do_not_hide_it():
    spaced, plain = "GB82 WEST 1234 5698 7654 32", "GB82WEST12345698765432"
    assert ibans(f"{spaced} EUR 500") == [spaced]
    assert ibans(f"{plain} I think") == [plain]
    assert ibans(f"{spaced} DE89 3704 0044 0532 0130 00 USD") == [spaced, "DE89 3704 0044 0532 0130 00"]
    assert ibans(f"REF AB12 3456 7890 12 {plain} OK") == [plain]
    assert ibans("GB82 WEST 1234 5698 7654 33 EUR 500") == [] and ibans(plain + "X") == []
