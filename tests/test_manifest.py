import hashlib

import numpy as np

from kinfold.sources import files

CONTENTS = {
    "plain.txt": b"one\ntwo\nthree", "ended.txt": b"one\ntwo\n\n\n", "ends.txt": b"\n" * 5000, "returns.csv": b"a,b\r\n1,2\r\n" * 400,
    "marked.csv": b"\xef\xbb\xbfa,b\n1,2\n" * 3, "mark.txt": b"\xef\xbb\xbf", "marked_end.txt": b"\xef\xbb\xbf\n", "zeros.bin": bytes(70_000),
    "packed.gz": b"not packed at all\n" * 9, "a[b]{c}*? %20.bin": np.random.default_rng(0).bytes(300_000), "even.bin": np.random.default_rng(1).bytes(65_536),
}


def _manifest(spark, tmp_path, **conf):
    for name, content in CONTENTS.items():
        (tmp_path / name).write_bytes(content)
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        rows = files.file_manifest(spark, str(tmp_path), "test").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    found = {r["path"].rsplit("/", 1)[1]: (r["size_bytes"], r["sha256"], r["source"]) for r in rows}
    assert len(rows) == len(found)
    assert found == {n: (len(c), hashlib.sha256(c).hexdigest(), "test") for n, c in CONTENTS.items()}


def test_a_file_larger_than_one_value_may_be_is_hashed(spark, tmp_path):
    """Files of over 2 GB ended the listing with an error; a lower limit stands for that here."""
    _manifest(spark, tmp_path, **{"spark.sql.sources.binaryFile.maxLength": "1000"})


def test_files_read_by_lines_have_the_hash_of_their_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "WHOLE_BYTES", 0)
    _manifest(spark, tmp_path)
    _manifest(spark, tmp_path, **{"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "1"})
