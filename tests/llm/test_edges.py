"""Every query on empty tables, null rows, very long texts, repeated rows and clashing further columns."""

import pytest

from foliant.llm import registry

from .conftest import item

QUERIES = registry.queries()
LONG = "word and another. " * 6000


def hard_rows():
    rows = [{}, item(1), item(2, deleted=True, title="x", abstract="y", fulltext="z", doi="10.1234/abcdef")]
    rows += [item(3, title="", abstract="", creators="", fulltext="", doi="", language="", date_modified="", fulltext_source="pdf")]
    rows += [item(4, title=LONG, abstract=LONG, creators=LONG, fulltext=LONG, fulltext_source="pdf", doi="10.1234/" + "a" * 500, language="en", date_modified="2020-01-01 00:00:00")] * 2
    rows += [item(5, title=LONG, abstract=LONG, creators=LONG, fulltext="x" * 30000, fulltext_source="pdf", doi="10.1234/" + "a" * 500, language="?", date_modified="nonsense")]
    return rows


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty(spark, library, name):
    assert QUERIES[name](spark, library()).count() in (0, 1)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_hard_rows(spark, library, name):
    documents = [{}, {"doc_id": 1}, {"doc_id": 2, "text": "", "source": " A-b"}, {"doc_id": 3, "text": LONG, "source": "a_b", "lang": "en"}, {"doc_id": 3, "text": LONG, "source": "a_b", "lang": "en"}]
    documents += [{"doc_id": 4, "text": "字" * 20000, "source": "c"}, {"doc_id": 5, "text": "퟿ \x00 ", "source": None}]
    creators = [{}, {"creator_id": 1}, {"creator_id": 2, "first_name": "", "last_name": " "}, {"creator_id": 3, "full_name": "x " * 5000}, {"creator_id": 4, "last_name": "Only"}, {"creator_id": 4, "last_name": "Only"}]
    targets = [{"source_name": "a_b", "target_share": 0.5, "max_repeats": 2}, {"source_name": "missing", "target_share": 0.5, "max_repeats": None}, {"source_name": None}]
    folder = library(zotero_items=hard_rows(), documents=documents, creators=creators, mix_targets=targets, extra=True)
    QUERIES[name](spark, folder).collect()
