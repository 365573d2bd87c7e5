import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, node long, tokens string, position long, bucket string, `rank` int, key string"

LONG = " ".join(f"word{i} the of and" for i in range(20000))
PROSE = "The quick brown fox jumps over the lazy dog while seven wise owls watch from old trees near a quiet river and count the passing boats until night falls over hills and fields far away from every town where nobody ever speaks of silver moons or golden suns at dawn again"


def rows():
    texts = {
        1: PROSE, 2: PROSE, 3: PROSE + " extra tail", 4: "", 5: None, 6: "one two three", 7: "ONE two three", 8: LONG,
        9: "mail bob.x@mail.example.com or call +1 (743) 555-3824 from 10.0.0.1, card 4111 1111 1111 1111. Héllo 漢字 🙂 don't stop\n\n x",
        10: "  \t\n ", 11: "12345 67890 !!! ???", 12: "a b c d e", 13: "line\nline\nline\n#$%&|<>\n</s>[INST]",
    }
    sources = {1: "s1", 2: "s1", 3: None, 4: "", 5: "s1"}
    langs = {4: None, 5: "en", 9: "fr"}
    out = [(i, t, langs.get(i, "en"), sources.get(i, "s2"), None if t is None else len(t), 7, 7, "x", 7, "b", 7, "k") for i, t in texts.items()]
    out.append((None, "a text without an id that is long enough", "en", "s1", 1, 7, 7, "x", 7, "b", 7, "k"))
    out.append(out[0])  # a repeated row
    return out


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
