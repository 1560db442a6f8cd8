"""Words of a slice are handled once each, whatever their number of occurrences."""

import pyarrow as pa

from roleatlas.llm import ngram_join, tokens
from roleatlas.llm.catalog import word_bpe
from roleatlas.llm.words import distinct_words

ODD = ["", None, "a", " \t", "A b\x0bB a", "x\x1cy z q", "Ünï Ça ça", "\r\nend ", "b" * 300]


def test_distinct_words_are_those_of_split():
    for texts in (ODD, ODD[2:3], ["", None], [], ODD[::-1]):
        array = pa.concat_arrays([pa.array(["cut off"]), pa.array(texts, pa.string())]).slice(1)
        number, counts, words = distinct_words(array)
        lists = [(t or "").encode().lower().split() for t in texts]
        assert counts.tolist() == [len(x) for x in lists]
        assert [words[n].as_py() for n in number.tolist()] == [w for x in lists for w in x]
        assert len(set(words.to_pylist())) == len(words) == len({w for x in lists for w in x})


def test_known_words_are_not_taken_apart_again(monkeypatch):
    own, texts, seen = tokens.Encoder(word_bpe()), pa.array(["alpha beta gamma alpha", "Beta ça", None]), []
    first, begins = own.encode(texts)
    wanted = [own.whole(t or "") for t in texts.to_pylist()]
    assert [first[a:b].tobytes() for a, b in zip(begins, begins[1:])] == wanted
    monkeypatch.setattr(tokens, "pieces_of", lambda word, real=tokens.pieces_of: (seen.append(word), real(word))[1])
    assert own.encode(texts)[0].tolist() == first.tolist() and not seen


def test_words_are_taken_apart_at_once(monkeypatch):
    """Only words with an apostrophe or a rare character are looked at one by one."""
    texts = pa.array(["Alpha, beta. 3x12 <b> ça(Ÿ) a<| don't |", None, "日本 İx l'eau <|endoftext|> \x7f ½'s"])
    number, counts, words = distinct_words(texts)
    asked = []
    monkeypatch.setattr(tokens, "pieces_of", lambda word, real=tokens.pieces_of: (asked.append(word), real(word))[1])
    odd = sorted(["a<|", "don't", "日本", "İx", "l'eau", "<|endoftext|>", "\x7f", "½'s"])
    tokens.Encoder(word_bpe()).encode(texts)
    assert sorted(asked) == odd
    pieces, first, count = tokens.take_apart(words)
    for k, word in enumerate(words.to_pylist()):
        of = pieces.slice(first[k], count[k]).to_pylist()
        assert of == (tokens.RARE.search(word.decode()) and [word.decode()] or tokens.PIECES.findall(word.decode().lower()))
    assert sorted(asked) == sorted(odd * 2)
    none = tokens.take_apart(distinct_words(texts[1:2])[2])
    assert [len(x) for x in none] == [0, 0, 0]


def test_new_pieces_only_reach_the_tokenizer(monkeypatch):
    own, asked = tokens.Encoder(word_bpe()), []
    monkeypatch.setattr(own, "learn", lambda pieces, real=own.learn: (asked.extend(pieces), real(pieces))[1])
    texts = pa.array(["alpha, beta gamma.", "Beta, ça <| " + "b" * 900])
    for most, again in ((tokens.KNOWN_MOST, ["b" * 900]), (3, None)):
        monkeypatch.setattr(tokens, "KNOWN_MOST", most)
        asked.clear()
        for k in range(3):
            ids, begins = own.encode(texts)
            wanted = [own.whole(t) for t in texts.to_pylist()]
            assert [ids[a:b].tobytes() for a, b in zip(begins, begins[1:])] == wanted
            assert len(own.known) == len(own.sizes) <= most and own.sizes.sum() == len(own.ids)
            if k and again:
                # What is known is not encoded again; only a very long piece is not kept.
                assert asked == again
            asked.clear()


def test_shingles_number_each_word_once(monkeypatch):
    asked = []

    def spy(self, words, real=ngram_join.WordNumbers.of):
        asked.extend(words)
        return real(self, words)

    monkeypatch.setattr(ngram_join.WordNumbers, "of", spy)
    shingle, begins = ngram_join.shingle_sets(pa.array(["one two three " * 50, "ONE two", None, "four"]))
    assert begins.tolist() == [0, 3, 4, 4, 5] and len(shingle) == 5
    assert sorted(asked) == [b"four", b"one", b"three", b"two"]
