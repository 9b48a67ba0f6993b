"""C36 / K1 / K2 on an insights document fixture."""

from ledgerlens.operators import text as K

INSIGHTS = """Intro line before any heading
1. **Orphan** item
## Funding
1. **Seed** rounds dominate
2. Late stage is rare
2. duplicate number ignored
## Geography
3. Hubs are concentrated
"""


def test_extract_numbered_items(spark):
    docs = spark.createDataFrame([(1, INSIGHTS)], "doc_id int, text string")
    items = K.extract_numbered_items(docs, "doc_id").orderBy("number").collect()
    assert [(r.number, r.section, r.item) for r in items] == [
        (1, "General", "Orphan item"), (2, "Funding", "Late stage is rare"), (3, "Geography", "Hubs are concentrated")]


def test_search(spark):
    docs = spark.createDataFrame([(1, INSIGHTS), (2, "nothing here\n\n")], "doc_id int, text string")
    hits = K.search_documents(docs, "doc_id", "HUBS", k=3).collect()
    assert [(h.doc_id, h.line_no) for h in hits] == [(1, 8)]
    items = K.extract_numbered_items(docs, "doc_id")
    assert K.search_insights(items, "seed", "Funding").count() == 0  # number 1 kept from first occurrence
    assert K.search_insights(items, "hubs").count() == 1


def test_only_two_signs_make_a_heading(spark):
    docs = spark.createDataFrame([(1, "# Title\n1. first\n### Deep\n2. second\n## Part\n3. third")], "doc_id int, text string")
    items = K.extract_numbered_items(docs, "doc_id").orderBy("number").collect()
    assert [(r.number, r.section) for r in items] == [(1, "General"), (2, "General"), (3, "Part")]


def _expected_items(docs):
    """Plain per-document scan: the definition C36 must reproduce."""
    import re
    out = {}
    for key, text in docs:
        section, seen = "General", set()
        for line in text.split("\n"):
            h = re.match(r"^\s*##\s+(.+?)\s*$", line)
            if h:
                section = h.group(1)
                continue
            m = re.match(r"^\s*(\d+)\.\s+(.*\S)\s*$", line)
            if m and int(m.group(1)) not in seen:
                seen.add(int(m.group(1)))
                out[(key, int(m.group(1)))] = (section, m.group(2).replace("**", "").strip())
    return out


def test_distributed_paths_match_per_document_scan(spark):
    """Headings carried across partition borders,
    never across documents; one hot document holds most lines."""
    import random

    rnd = random.Random(7)
    docs = []
    for d in range(6):
        n = 3000 if d == 2 else rnd.randint(0, 60)
        lines = []
        for _ in range(n):
            r = rnd.random()
            if r < 0.03:
                lines.append(f"## Part {rnd.randint(0, 99)}")
            elif r < 0.6:
                lines.append(f"{rnd.randint(1, 400)}. item **{rnd.randint(0, 9)}** hubs")
            else:
                lines.append(rnd.choice(["", "plain text", "Hubs and more"]))
        docs.append((d, "\n".join(lines)))
    frame = spark.createDataFrame(docs, "doc_id int, text string").repartition(3)
    got = {(r.doc_id, r.number): (r.section, r.item)
           for r in K.extract_numbered_items(frame, "doc_id").collect()}
    assert got == _expected_items(docs)
    hits = K.search_documents(frame, "doc_id", "hubs", k=3).collect()
    for key, text in docs:
        found = [i + 1 for i, ln in enumerate(text.split("\n")) if ln.strip() and "hubs" in ln.lower()]
        mine = sorted((h.hit_no, h.line_no, h.matches) for h in hits if h.doc_id == key)
        assert mine == [(j + 1, ln, len(found)) for j, ln in enumerate(found[:3])]
