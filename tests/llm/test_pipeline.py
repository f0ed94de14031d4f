"""The pipeline: its stages on planted cases, and a whole run."""

import random
import re
from itertools import combinations
from pathlib import Path

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from flightloom.llm import ngram_join, pii, queries

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark, edge_docs):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "ngram_join", "pii", "packing"]
    docs = edge_docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == edge_docs.columns, name
        assert [f.dataType for f in docs.schema] == [f.dataType for f in edge_docs.schema]
    rows = docs.collect()
    texts = {r.doc_id: r.text for r in rows}
    assert 2 not in texts and sum(r.doc_id == 1 for r in rows) == 1  # near copy and repeated row
    assert {None, 3, 4, 5, 6, 7, 8, 9, 10, 12} <= set(texts)
    assert texts[11] == "other\nrest" and "[EMAIL]" in texts[12]
    assert all(r.n_chars == len(r.text) for r in rows if r.text is not None)


def test_whole_run(spark):
    packed = queries.table(spark, SF_DIR, "documents")
    out = corpus_pipeline.run(spark, SF_DIR)
    kept = {r.doc_id for r in out.select("doc_id").distinct().collect()}
    assert kept < {r.doc_id for r in packed.collect()} and len(kept) > 100
    docs = packed
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, SF_DIR)
    final = docs.collect()
    assert {r.doc_id for r in final} == kept
    groups = [r.component_id for r in ngram_join.join(docs).collect()]
    assert len(groups) == len(final)
    assert not any(pii.base_spans(r.text) for r in final if r.text)
    assert out.agg({"offset": "max"}).first()[0] < 1024


INSULTS = ["zorgoth", "blixnar", "quavdel", "mirgush", "trondak", "vexplum", "skarnid", "ploffet", "grundle", "wazzick"]


def planted(seed=4):
    """(id, text, label) of plain documents, toxic ones, copies, near copies, repeated passages and personal data, and the ids of all toxic ones."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("bcdfghklmnprstvw") + rng.choice("aeiou") for _ in range(rng.randint(2, 4))) for _ in range(600)]
    plain = lambda n=3: "\n".join(" ".join(rng.choices(words, k=20)) for _ in range(n))
    rows, toxic = [], set()
    for doc_id in range(400):
        text = plain()
        if doc_id % 9 == 4:
            toxic.add(doc_id)
            text = " ".join(rng.choice(INSULTS) if rng.random() < 0.4 else w for w in text.split(" "))
        rows.append([doc_id, text, int(doc_id in toxic) if doc_id % 3 else None])
    passage = plain(3)
    for doc_id in (400, 401, 402):  # a passage of three lines that stands in three documents
        rows.append([doc_id, plain(2) + "\n" + passage + "\n" + plain(1), None])
    rows.append([403, rows[10][1], None])  # an exact copy
    for doc_id, of in ((404, 11), (405, 12), (406, 404)):  # near copies, one of a near copy
        text = rows[of][1].split(" ")
        text[5 if doc_id < 406 else 9] = "changed"
        rows.append([doc_id, " ".join(text), None])
    rows.append([407, plain(1) + " jane.doe@example.org, host 10.0.0.1 +49 (30) 1234-5678\n" + plain(1), None])
    rows += [[408, None, None], [409, "", None], [410, "short text", None]]
    return rows, toxic


def survivors_by_hand(rows, toxic):
    """The five stages' decisions by plain loops: id → final text."""
    kept = {i: t for i, t, _ in rows if i not in toxic}
    seen, deduped = set(), {}
    for doc_id, text in sorted(kept.items()):
        if not text:
            deduped[doc_id] = text
            continue
        lines = text.split("\n")
        runs = [tuple(lines[i : i + 3]) for i in range(len(lines) - 2)]
        gone = {k for i, run in enumerate(runs) if run in seen for k in range(i, i + 3)}
        seen.update(runs)
        if len(gone) < len(lines):
            deduped[doc_id] = "\n".join(line for i, line in enumerate(lines) if i not in gone)

    def shingles(text):
        words = (text or "").lower().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets, label = {i: shingles(t) for i, t in deduped.items()}, {i: i for i in deduped}
    links = [(a, b) for a, b in combinations(sorted(sets), 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    out = {}
    for doc_id, text in deduped.items():
        if label[doc_id] == doc_id:
            for kind, start, end in sorted(pii.base_spans(text or ""), key=lambda s: -s[1]):
                text = text[:start] + f"[{kind.upper()}]" + text[end:]
            out[doc_id] = text or ""
    return out


def test_planted_cases_by_hand(spark, tmp_path):
    rows, toxic = planted()
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t) if t is not None else None) for i, t, _ in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, label) for i, _, label in rows if label is not None], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces: dict[int, list] = {}
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.ids))
    got = {}
    for doc_id, parts in pieces.items():
        ids = [i for _, part in sorted(parts) for i in part]
        assert ids[-1] == 0
        got[doc_id] = tokenizer.decode(ids[:-1], skip_special_tokens=False)
    want = survivors_by_hand(rows, toxic)
    assert {403, 404, 405, 406}.isdisjoint(want) and {400, 401, 402, 407, 408, 409} <= set(want)
    assert got == want


def test_no_local_checkpoints_or_machine_folders():
    source = "\n".join(p.read_text() for p in [*Path("flightloom/llm").glob("*.py"), Path("corpus_pipeline.py")])
    assert not re.search("localCheckpoint|tempfile|crossJoin|except ImportError", source)
