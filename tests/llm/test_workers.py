"""Word-wise encoding against the tokenizer, and workers that lack the package."""

import os
import subprocess
import sys

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from roleatlas.llm import tokens
from roleatlas.llm.catalog import word_bpe

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

RUN = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", {scratch!r}).config("spark.sql.shuffle.partitions", "2").getOrCreate())
from roleatlas.llm import alignment, catalog, conversations, ngram_join, packing
import public_tokenizers
docs = spark.createDataFrame([(k, f"Some words, {{k}} of them.") for k in range(20)], "doc_id long, text string")
print("packed", packing.pack_documents(docs, catalog.word_bpe()).count())
paths = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
print("aligned", alignment.align_tokenizers(docs, *paths).count())
print("joined", ngram_join.ngram_components(docs).count())
rows = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes.")], "conv_id long, turn long, role string, text string")
print("audits", conversations.repair_conversations(rows).audits.count())
"""


def test_workers_without_the_package(tmp_path):
    """Only the driver finds the package; kernels travel with their code."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = RUN.format(root=ROOT, scratch=str(tmp_path / "shared"))
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.stdout.split() == ["packed", "20", "aligned", "20", "joined", "20", "audits", "1"], done.stderr[-2000:]


def thue_morse(n):
    word = b"a"
    while len(word) < n:
        word += word.translate(bytes.maketrans(b"ab", b"ba"))
    return word[:n].decode()


@pytest.mark.parametrize("texts", [
    # Two words that many polynomial hashes take for one.
    [thue_morse(1024), thue_morse(1024).translate(str.maketrans("ab", "ba"))],
    ["a.b c! d?! É, . !! 3. x3. ok;"] + [f"{chr(c)}x {chr(c)} a{chr(c)}." for c in range(33, 0x180)],
    ["", "One two  three\tone", "ÉCOLE İstanbul ß ﬁn", "a" * 5000, "x\x0by\x0cz\r\nw", "<|endoftext|> 5's don't"],
])
def test_ids_are_the_tokenizers(texts):
    whole = Tokenizer.from_file(word_bpe())
    ids, begins = tokens.Encoder(word_bpe()).encode(pa.array(texts))
    for k, text in enumerate(texts):
        assert ids[begins[k]:begins[k + 1]].tolist() == whole.encode(text, add_special_tokens=False).ids
