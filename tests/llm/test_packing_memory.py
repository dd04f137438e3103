"""Encodings take many times the room of their ids: few are made at once."""


def test_few_encodings_at_once(monkeypatch):
    import public_tokenizers

    from millrace.llm import packing as P

    words = P.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    encode, sizes = words._encode, []

    def counted(parts):
        sizes.append((len(parts), max(map(len, parts), default=0)))
        return encode(parts)

    monkeypatch.setattr(words, "_encode", counted)
    letters = [chr(97 + k % 26) + chr(97 + k // 26 % 26) + chr(97 + k // 676) for k in range(9000)]
    got = next(words.encode([" ".join(letters).encode()]))
    assert got.tolist() == words.tokenizer.encode(" ".join(letters), add_special_tokens=False).ids
    assert max(n for n, longest in sizes if longest > 100) <= 8


def test_remembered_words_are_small():
    import public_tokenizers

    from millrace.llm import packing as P

    words = P.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    texts = [" ".join(f"{chr(97 + k % 26)}{chr(97 + j % 26)}{chr(97 + j // 26)}{end}" for j in range(600)) for k, end in enumerate(["", ".", ",", "..", "'s", "é", "1.", "\t.\n"])]
    texts += ["", ".", " a. b., c,.\r\nd.\x0b.\x0c,e. f. ", "A.B. C,\n", "<|x|> a."]
    for got, text in zip(words.encode([t.encode() for t in texts]), texts, strict=True):
        assert got.tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids
    held = vars(words)
    assert not [k for k, v in held.items() if isinstance(v, dict | list | set)]  # no Python object for each word
    assert sum(held[k].nbytes for k in ("known", "place", "start", "length", "ids")) < 48 * len(words.known)
