import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from leafline.llm.bpe import RankArrayBpe, bpe_round_trip

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY, OWN = Tokenizer.from_file(PATH), RankArrayBpe(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=60))
def test_any_text(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert OWN.encode(text) == ids
    assert OWN.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_special_tokens_and_long_words():
    for text in ("a<|endoftext|>b <|endoftext|>", "ab" * 4000, "=" * 3000, "don't we'll'S", "\r\n \x0b\x85x"):
        assert OWN.encode(text) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_ids_that_are_no_text():
    ids = [OWN.byte_ids[0xE6], OWN.byte_ids[0x41], 10**9]
    assert OWN.decode(ids) == "�A"


def test_rows(table, awkward):
    done = {(r["doc_id"], r["decoded"], tuple(r["ids"])) for r in bpe_round_trip(table(awkward), PATH).collect()}
    assert done == {(i, t or "", tuple(LIBRARY.encode(t or "", add_special_tokens=False).ids)) for i, t in awkward}
    assert bpe_round_trip(table([]), PATH).collect() == []
