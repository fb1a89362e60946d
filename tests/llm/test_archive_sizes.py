"""Archive files are closed by bytes."""

from pricebeam.llm import warc
from pricebeam.llm.warc import read_archives, write_archives


def test_files_of_large_pages_stay_small(spark, scratch, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 1 << 17, raising=False)
    monkeypatch.setattr(warc, "FILE_RECORDS", (64, 16, 4, 1), raising=False)
    sizes = [10, 3000, 20000, 60000, 200000] * 30
    pages = spark.createDataFrame([(i, f"http://h.example/{i}", chr(97 + i % 26) * n + str(i)) for i, n in enumerate(sizes)],
                                  "page_id long, url string, html string").coalesce(1)
    path = scratch("archives")
    write_archives(pages, path)
    files = [(x.length, x.path) for x in spark.read.format("binaryFile").load(path).select("length", "path").collect()]
    found = read_archives(spark, path).collect()
    assert sorted((x.page_id, x.payload_bytes) for x in found) == [(i, n + len(str(i))) for i, n in enumerate(sizes)]
    alone = [x for x in files if x[0] > 1 << 17]
    assert len(alone) == 30 and len({x.run for x in found if x.payload_bytes > 1 << 17}) == 30
    assert all(sum(y.run == x[1] for y in found) == 1 for x in alone)
