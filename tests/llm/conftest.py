from datetime import datetime

import pytest

ITEMS = (
    "item_id long, item_key string, version int, library_id int, item_type_id int, item_type string, doi string, title string, abstract string, creators string, "
    "fulltext string, fulltext_source string, notes string, extra string, language string, deleted boolean, collections array<string>, date_added string, date_modified string, synced_at timestamp"
)
SCHEMAS = {
    "zotero_items": ITEMS,
    "creators": "creator_id long, first_name string, last_name string, full_name string",
    "documents": "doc_id long, text string, lang string, source string, n_chars int, item_key string, collection_key string, ingested_at timestamp",
    "mix_targets": "source_name string, target_share double, max_repeats int",
    "size_limits": "limit_name string, unit string, limit_value int, overlap_value int",
}
EXTRA = {name: ", key string, n long, words string, label string, value double, text2 string, h long" for name in ("zotero_items", "creators", "documents")}
LIMITS = [("fulltext_piece", "characters", 100, 10), ("container", "tokens", 50, 0)]
WHEN = datetime(2024, 1, 1)


def rows_of(schema: str, dicts: list[dict]) -> list[tuple]:
    names = [c.split()[0] for c in schema.replace("array<string>", "array").split(", ")]
    return [tuple(d.get(n) for n in names) for d in dicts]


@pytest.fixture
def library(spark, tmp_path):
    """Writes the given rows (dicts) as tables of a folder; tables not given are empty, limits have small defaults."""
    made = [0]

    def make(**tables) -> str:
        made[0] += 1
        folder = tmp_path / f"t{made[0]}"
        extra = tables.pop("extra", False)
        for name, schema in SCHEMAS.items():
            full = schema + EXTRA.get(name, "") if extra else schema
            rows = tables.get(name)
            data = [tuple(r) for r in LIMITS] if rows is None and name == "size_limits" else rows_of(full, rows or [])
            spark.createDataFrame(data, full).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
        return str(folder)

    return make


def item(item_id, **fields):
    return {"item_id": item_id, "item_type": "journalArticle", "synced_at": WHEN} | fields
