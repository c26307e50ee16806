"""Own landing fixtures in the producer's file shapes (hand-written, small, exhaustive on
the edge cases: repeated run ids with different bytes, blank lines, error rows, an
unseeded retriever, missing resolved model ids, prices without cache rates, a curated
override, ground truth with null / empty-string elements, a question missing from the bank).
"""

from __future__ import annotations

import json
from pathlib import Path

OLD, NEW = "20260601T000000Z", "20260602T000000Z"
HAIKU = "claude-haiku-4-5-20251001"


def manifest(run_id, retriever, provider="anthropic", harness="harness-v2", corpus=None, resolved=HAIKU, temp=0.0,
             **extra):
    m = {
        "run_id": run_id, "timestamp": "2026-05-04T08:15:42+0200", "retriever": retriever,
        "generator_provider": provider, "generator_model": "claude-haiku-4-5", "judge": "deterministic-v1",
        "questions_path": "q.jsonl", "num_questions": 2, "system_prompt_sha256": "0f1e2d3c4b5a6978",
        "harness_version": harness, "prompts": {"unknown": "tolerated"},
    }
    if resolved is not None:
        m["generator_model_resolved"] = resolved
    if temp is not None:
        m["generator_temperature"] = temp
    if corpus is not None:
        m["corpus_build_id"] = corpus
    m.update(extra)
    return m


def answer(qid, retriever, type_id="02_1hop_factoid", scoring="set_match", **kw):
    a = {
        "question_id": qid, "type_id": type_id, "scoring": scoring, "question": f"Q {qid}?",
        "ground_truth": ["A"], "retriever": retriever, "generator_provider": "anthropic",
        "generator_model": "claude-haiku-4-5", "predicted": "A", "input_tokens": 10, "output_tokens": 1,
        "context_tokens_proxy": 5, "num_sources": 1, "retrieval_latency_ms": 10.0, "generation_latency_ms": 20.0,
        "judged": True, "passed": True, "score": 1.0, "verdict": "ok", "judge_details": {"basis": "set"},
    }
    a.update(kw)
    return {k: v for k, v in a.items() if v is not _ABSENT}


_ABSENT = object()
ABSENT = _ABSENT

RECORDS = {
    "r1-vector": [
        answer("q1", "vector", generator_model_resolved=HAIKU, generator_temperature=0.0, input_tokens=1000,
               output_tokens=200, cache_read_input_tokens=300, cache_creation_input_tokens=100,
               traversal_info={"mechanism": "dense", "top_k": 5, "num_chunks": 3, "embed_model": "mini"}),
        answer("q2", "vector", scoring="string_match", passed=False, score=0.5),
        answer("q3", "vector", generator_model_resolved="claude-2.1", error="timeout", passed=_ABSENT,
               score=_ABSENT, judged=False, retrieval_latency_ms=_ABSENT, generation_latency_ms=_ABSENT),
    ],
    "r2-sparql": [
        answer("q1", "graph_sparqlgen", generator_model_resolved=HAIKU, input_tokens=100, output_tokens=10,
               traversal_info={"mechanism": "sparqlgen", "writer_model": HAIKU, "writer_temperature": 0.0,
                               "writer_input_tokens": 500, "writer_output_tokens": 100, "sparql_valid": True,
                               "num_rows": 3, "sparql": "SELECT 1"}),
        answer("q4", "graph_sparqlgen", type_id="08_negative_unanswerable", passed=False, score=0.0,
               traversal_info={"mechanism": "sparqlgen", "writer_model": "claude-x-unpriced-20250101",
                               "writer_input_tokens": 7, "writer_output_tokens": 3, "sparql_valid": False}),
    ],
    "r3-closed": [
        answer("q2", "closed_book", scoring="string_match", generator_provider="ollama",
               generator_model="qwen2.5:3b-instruct", generator_model_resolved="qwen2.5:3b-instruct",
               input_tokens=50, output_tokens=5, retrieval_latency_ms=0.0, traversal_info={"retriever": "none"}),
        answer("q5", "hybrid_x", type_id="99_unknown", error="", traversal_info={}),
    ],
}

QUESTIONS = [
    {"question_id": "q1", "type_id": "02_1hop_factoid", "template_id": "t1", "question": "Q q1?",
     "scoring": "set_match", "answer_var": "x", "ground_truth": ["A", "B"], "seeds": ["s1", "s2"]},
    {"question_id": "q2", "type_id": "01_0hop_attribute", "template_id": "t2", "question": "Q q2?",
     "scoring": "string_match", "answer_var": "x", "ground_truth": "X"},
    {"question_id": "q3", "type_id": "04_3plus_hop_traversal", "template_id": "t3", "question": "Q q3?",
     "scoring": "set_match", "answer_var": "x", "ground_truth": [], "seeds": []},
    {"question_id": "q4", "type_id": "08_negative_unanswerable", "template_id": "t4", "question": "Q q4?",
     "scoring": "set_match", "answer_var": "x", "ground_truth": ["", None, "C"], "seeds": ["s"]},
]

PROFILES = {
    "full-aa00bb11": {"corpus_build_id": "full-aa00bb11", "scale": "full", "measured_at": "2026-05-09T10:20:30+0200",
                      "graph": {"ttl_bytes": 10, "ttl_sha256": "abc", "triples": 7000123, "nodes": 5, "edges": 6},
                      "vector": {"store_bytes": 1, "n_chunks": 90210, "n_abstracts": 40404, "n_words": 9,
                                 "embed_model": "mini", "chunk_size": 256, "chunk_overlap": 48}},
    "smoke-cc22dd33": {"corpus_build_id": "smoke-cc22dd33", "scale": "smoke",
                       "measured_at": "2026-05-09T10:20:30+0200",
                       "graph": {"ttl_bytes": 12345, "triples": None, "nodes": None, "edges": None},
                       "vector": {"store_bytes": 654321, "n_chunks": 17, "n_abstracts": 9, "n_words": 2718,
                                  "embed_model": "mini", "chunk_size": 256, "chunk_overlap": 48}},
}


def _paygo(req, resp, cr=None, cw=None):
    p = {"request_token": {"price": req}, "response_token": {"price": resp}}
    if cr is not None:
        p["cache_read_input_token"] = {"price": cr}
    if cw is not None:
        p["cache_write_input_token"] = {"price": cw}
    return {"pricing_config": {"pay_as_you_go": p, "batch_config": {"request_token": {"price": req / 2}}}}


PRICING = {
    "meta": {"provider": "anthropic", "fetched_at": "2026-06-27", "ref": "main", "source_url": "x", "model_count": 4},
    "models": {
        HAIKU: _paygo(1e-04, 5e-04, 1e-05, 1.25e-04),
        "claude-2.1": _paygo(0.0008, 0.0024),
        "default": _paygo(0, 0, 0, 0),
        "qwen2.5:3b-instruct": _paygo(0.001, 0.001, 0.001, 0.001),
    },
}


def _jsonl(records, pad=True) -> str:
    lines = []
    for i, r in enumerate(records):
        lines.append(("   " if pad and i == 1 else "") + json.dumps(r))
        if pad and i == 0:
            lines.extend(["", "   "])
    return "\n".join(lines) + "\n"


def write_tree(root: Path, with_questions: bool = True) -> Path:
    root = Path(root)
    (root / OLD).mkdir(parents=True)
    (root / NEW).mkdir(parents=True)
    (root / "reference" / "pricing").mkdir(parents=True)
    # r1 exists in both batches with different bytes; the newest batch wins
    (root / OLD / "r1-vector.manifest.json").write_text(json.dumps(manifest("r1-vector", "vector", harness="harness-v1",
                                                                            corpus="full-aa00bb11")))
    (root / OLD / "r1-vector.jsonl").write_text(json.dumps(answer("stale", "vector")) + "\n")
    (root / NEW / "r1-vector.manifest.json").write_text(json.dumps(manifest("r1-vector", "vector",
                                                                            corpus="full-aa00bb11")))
    (root / NEW / "r2-sparql.manifest.json").write_text(json.dumps(manifest("r2-sparql", "graph_sparqlgen",
                                                                            resolved=None, temp=None)))
    (root / NEW / "r3-closed.manifest.json").write_text(json.dumps(manifest(
        "r3-closed", "closed_book", provider="ollama", corpus="unknown-abc123", resolved="qwen2.5:3b-instruct")))
    for run_id, recs in RECORDS.items():
        (root / NEW / f"{run_id}.jsonl").write_text(_jsonl(recs))
    if with_questions:
        (root / "reference" / "questions.jsonl").write_text("\n".join(json.dumps(q) for q in QUESTIONS) + "\n\n")
    for cid, p in PROFILES.items():
        (root / "reference" / f"{cid}.json").write_text(json.dumps(p, indent=2))
    (root / "reference" / "pricing" / "anthropic.json").write_text(json.dumps(PRICING, indent=2, sort_keys=True))
    return root
