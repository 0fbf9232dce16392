"""Raw files: what is read of them, whatever ranges they come in."""

import itertools

import pytest

from quillmill.sources import files

FILES = {
    "long.csv": b"id,text\n" + b"".join(b'%d,"%s"\n' % (i, b'line one\nline ""two"", ' * 9000) for i in range(3)),
    "sub dir/a b%20ü.CSV": b'\xef\xbb\xbfx,y\r\n1,"a\r\nb"\r\n\r\n3,4,5\r6,"gr\xc3\xb6\xff\xc3"\r\n7,"open to the end\n',
    "open.csv": b'x,y\n1,"never closed\n\nat all', "mac.csv": b"x,y\r1,2\r3,4", "head.csv": b"x,y\n", "empty.csv": b"",
    "a.jsonl": b'{"a": [1, {"b": "c"}]}\n\nnot json\x0b{"x": 1}\r\n["l"]\n{"t": "' + "grö€\u2028".encode() * 5000 + b'"}', "bom.JSONL": b'\xef\xbb\xbf{"a": 1}\n{"a": 2}\n',
    "n.txt": b"one\r\n\r\n\r\n\r\ntwo", "bad.json": b"{", "l.json": b'[{"a": 1}, 2, ""]', "none.bin": b"x", "plain": b"x",
}


@pytest.mark.parametrize("bytes_a_range", [997, 1 << 27])
def test_files_are_read_as_they_are_parsed(spark, tmp_path, bytes_a_range):
    for name, data in FILES.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", bytes_a_range)
    try:
        got = files.read_documents(spark, str(tmp_path), "node").select("source_path", "format", "title", "record_index", "text", "payload_json", "error").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = [(name, *r) for name, data in FILES.items() for r in files.parse(name, data) if r[5] is not None or r[3]]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert {n for n, *_ in want} == set(FILES) - {"head.csv", "empty.csv", "none.bin", "plain"}


@pytest.mark.parametrize(("name", "line"), [("a.csv", "1,2\n"), ("a.jsonl", '{"a": 1}\n')])
def test_records_come_before_their_file_has_been_read(name, line):
    taken = []
    chunks = (taken.append(i) or line for i in itertools.count())
    assert len(list(itertools.islice(files._records(*files._kind(name), chunks), 100))) == 100
    assert len(taken) < 200
