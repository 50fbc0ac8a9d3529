"""Operator 2: ids of the registered query against the tokenizer exactly as loaded."""
import zlib

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from eventide.llm import idpack
from eventide.llm.queries import op2_idpack

END = "<|endoftext|>"


def test_op2_query_encodes_added_tokens_as_the_library_does(spark, tmp_path):
    rows = [(1, f"a{END}b"), (2, "plain text here"), (3, END), (4, f"{END}{END} x {END}\n"), (5, "<|endof"), (6, "text|> y"),
            (7, f"  don't {END} 漢字 é"), (None, f"no id{END}"), (8, None), (9, ""), (10, "<|endoftext |>")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    t, start, want = Tokenizer.from_file(P.path("byte_bpe_50k.json")), 0, []
    for d, text in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted(map(tuple, op2_idpack(spark, str(tmp_path)).collect()), key=lambda r: r[1])
    assert got == want


def test_rows_with_added_tokens():
    rows = ["x" + END, "<|endof", "text|>", "", END + END, "plain", "<|" + END]
    raw = [r.encode() for r in rows]
    off = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    assert idpack.rows_with(data, off, [END.encode()]) == {0, 4, 6}
    assert idpack.rows_with(data, off, []) == set()
