"""Whole documents: header fields, sections, JSON in and out, streams."""

import json

import pytest
from pyspark.sql import functions as F

from formloom.operators import anchors as A
from formloom.operators import header as H
from formloom.operators import lookup, quality, sections
from formloom.plans import cli, pipeline
from formloom.sources import documents as D
from formloom.sources import settings, tables, templates
from formloom.streaming import files

COLUMNS = "doc_id string, det_idx int, text string, confidence double, cx int, cy int, x0 int, y0 int, x1 int, y1 int, region_id string, width int, height int"


def det(text, cx, cy, confidence=0.98, region="header", half=30, tall=20):
    return (text, confidence, cx, cy, cx - half, cy - tall, cx + half, cy + tall, region)


def frame(spark, **docs):
    rows = [(name, i, *d, 2480, 3508) for name, ds in docs.items() for i, d in enumerate(ds)]
    return spark.createDataFrame(rows, COLUMNS)


def corner(number, date, confidence=0.98):
    cells = [det("Номер", 2000, 100), *(det(t, 2000 + k, 160 + k, confidence) for k, t in enumerate(number)), det("Дата", 2200, 100)]
    return cells + [det(t, x, 160, confidence) for t, x in zip(date, (2180, 2220, 2260))]


def fields(spark, **docs):
    made = quality.long_fields(H.extract_header(A.pages(frame(spark, **docs))), [*H.MANDATORY, "part_name"])
    return {(r.doc_id, r.field): r for r in made.collect()}


def test_number_and_date_in_the_corner(spark):
    got = fields(
        spark, clean=corner(["057/25"], ["15", "10", "2025"]), slash=corner(["057I25"], ["01", "12", "2025"]), split=corner(["057", "/", "25"], ["15", "10"]),
        low=corner(["057"], ["15", "10", "2025"], 0.35), outside=[det("Номер", 300, 700), det("057", 300, 760), det("Дата", 600, 700)],
    )
    value = lambda d, f: got[d, f].value if (d, f) in got else None
    assert value("clean", "act_number") == "057/25" and not got["clean", "act_number"].corrected
    assert value("clean", "act_date") == "15/10/2025" and value("slash", "act_date") == "01/12/2025"
    assert value("slash", "act_number") == "057/25" and got["slash", "act_number"].corrected
    assert value("split", "act_number") == "057/25" and not got["split", "act_number"].corrected
    assert value("low", "act_number") == "057" and got["low", "act_number"].confidence == pytest.approx(0.35)
    assert value("outside", "act_number") == "057" and value("outside", "act_date") is None


def test_other_fields(spark):
    page = [
        det("Рев", 1500, 600), det("А 3", 1500, 660), det("КОЛ-ВО", 1000, 600), det("ПРОВЕРЕНО", 800, 700), det("7", 900, 700), det("100", 1000, 700), det("Контролер ОТК", 300, 900),
        det("Денисова Л.В.", 320, 960, 0.85), det("12345", 310, 970), det("☑ входной", 1200, 1000, 0.9), det("Наименование", 300, 400, half=60), det("Вал", 500, 400), det("Строка", 300, 1100), det("5", 420, 1100),
    ]
    got = {f: (r.value, r.confidence) for (_, f), r in fields(spark, a=page).items()}
    assert got["template_revision"][0] == "А3" and got["quantity_checked"][0] == "100" and got["control_type"] == ("входной", 0.9)
    assert got["inspector_name"] == ("Денисова Л.В.", pytest.approx(0.935)) and got["part_name"][0] == "Вал" and got["part_line_number"][0] == "5"


def test_sticker_wins(spark):
    page = [det("строка: 5", 200, 200, 0.6), det("кол-во: 50", 200, 240), det("дата: 10.10.2025", 200, 280), det("Строка: 9", 200, 300, 0.7), det("Клиент: ООО А", 220, 310)]
    header = H.extract_header(A.pages(frame(spark, a=page, b=[*page[:2], det("план", 2300, 1100)]))).orderBy("doc_id").collect()
    s = header[0].sticker
    assert (s.part_line_number.value, s.quantity_ordered.value, s.order_date.value, s.client.value) == ("9", "50", "10.10.2025", "ооо а")
    assert header[0].part_line_number.source == "sticker" and header[1].sticker is None and header[1].part_line_number.value == "5"


def test_sections(spark):
    z = lambda t, x, y, c=0.9: det(t, x, y, c, "analysis")
    d = lambda t, x, y, c=0.9: det(t, x, y, c, "defects")
    page = [d("ГЕОМЕТРИЯ", 300, 1300), d("№", 200, 1400), d("ПАРАМЕТР", 350, 1401), d("1", 200, 1460, 0.8), d("Длина", 350, 1462, 1.0), d("ОТВЕРСТИЯ", 1500, 1300)]
    page += [z("№", 100, 2400), z("Операция", 300, 2400), z("1", 100, 2480), z("Точение", 300, 2482), z("доработать 3", 100, 2600), z("Не использовать", 100, 2700)]
    page += [z("Руководитель", 100, 2800), z("Иванов И.И.", 300, 2800)]
    pages = A.pages(frame(spark, a=page))
    blocks = sections.defect_blocks(pages).collect()
    assert [(b.kind, b.title, b.headers) for b in blocks] == [("geometry", "ГЕОМЕТРИЯ", ["№", "ПАРАМЕТР"])]
    assert [(r.row_number, r.parameter, r.confidence) for r in blocks[0].rows] == [("1", "Длина", pytest.approx(0.9))]
    decided = sections.final_decision(pages).first()
    assert (decided.action, decided.quantity, decided.manager_name) == ("не использовать", 3, "Иванов И.И.")
    assert [(r.row_number, r.operation) for r in sections.analysis_rows(pages).collect()] == [("1", "Точение"), ("Руководитель", "Иванов И.И.")]


def test_corrections(spark):
    rows = lookup.correct(frame(spark, a=[det("Homep", 1, 1), det("Дaта", 1, 1), det("correct_text", 1, 1), det("мм", 1, 1), det("ДАТА", 1, 1), det(None, 1, 1)])).orderBy("det_idx").collect()
    assert [(r.text, r.corrected, r.original_text) for r in rows] == [
        ("Номер", True, "Homep"), ("Дата", True, "Дaта"), ("correct_text", False, None), ("мм", True, "мм"), ("Дата", True, "ДАТА"), (None, False, None),
    ]
    listed = lookup.correct_list(spark.createDataFrame([(1, ["x", "Homep"])], "id int, texts array<string>")).collect()
    assert [(r.position, r.original, r.corrected_text) for r in listed] == [(1, "Homep", "Номер")]


def test_mandatory_report(spark):
    header = H.extract_header(A.pages(frame(spark, a=corner(["057/25"], ["15", "10", "2025"], 0.6))))
    report = quality.mandatory_report(header).first()
    assert report.suspicious_fields == ["act_date", "act_number"] and report.missing_count == 5
    assert {r.field for r in quality.mandatory_missing(header).collect()} == set(report.mandatory_fields_missing)


def test_a_mean_at_the_threshold_is_not_below_it(spark):
    """Floating point puts the mean of the first page's date below 0.7."""
    dated = lambda *cs: [det("Дата", 2200, 100), *(det(t, x, 160, c) for t, x, c in zip(["15", "10", "2025"], (2160, 2200, 2240), cs))]
    header = H.extract_header(A.pages(frame(spark, a=dated(0.41, 0.7, 0.99), b=dated(0.41, 0.7, 0.98)))).persist()
    assert 0.6999 < header.where("doc_id = 'a'").first().act_date.confidence < 0.7
    reports = quality.mandatory_report(header).orderBy("doc_id").collect()
    assert [r.suspicious_fields for r in reports] == [[], ["act_date"]]
    assert [[e.field for e in r.errors if e.severity == "warning"] for r in reports] == [[], ["act_date"]]
    shown = quality.with_required_fields(header.select("doc_id"), header).orderBy("doc_id").collect()
    assert [s.act_date.suspicious for s in shown] == [False, True]


def document(boxes):
    return {
        "document_info": {"source_file": "a.jpg", "image_width": 2480, "image_height": 3508}, "text_regions": [],
        "ocr_results_by_region": {"header": [{"text": t, "confidence": c, "bbox": [[x - 30, y - 20], [x + 30, y - 20], [x + 30, y + 20], [x - 30, y + 20]], "center": [x, y]} for t, c, x, y in boxes]},
        "table_data_by_region": {"defects": {"type": "table", "cells": [{"row_idx": r, "col_idx": k, "text": f"{r}.{k}", "confidence": 0.9} for r in range(2) for k in (1, 0)]}},
    }


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    boxes = [("Номер", 0.9, 2000, 100), ("057I25", 0.9, 2000, 160), ("Дaта", 0.9, 2200, 100)]
    (tmp_path / "in" / "good-texts.json").write_text(json.dumps(document(boxes), indent=2, ensure_ascii=False))
    (tmp_path / "in" / "bad-texts.json").write_text("{not json")
    (tmp_path / "in" / "bare-texts.json").write_text('{"document_info": {}}')
    return tmp_path


def test_bad_files_are_rows(spark, folder):
    rows = {r.file_name: (r.status, r.error) for r in D.documents(spark, str(folder / "in"), regions_required=True).select("file_name", "status", "error").collect()}
    assert rows == {"good-texts.json": ("ok", None), "bad-texts.json": ("failed", "Invalid JSON"), "bare-texts.json": ("failed", "No ocr_results_by_region found in document")}


def test_pipeline_over_files(spark, folder):
    docs = D.documents(spark, str(folder / "in"))
    found = pipeline.run(D.detections(docs), D.cells(docs)).collect()
    assert len(found) == 1 and found[0].header.act_number.value == "057/25" and found[0].corrections == 2  # "Номер" has an entry for its lower-cased form
    assert [r.row_number for r in found[0].defects[0].rows] == ["1.0"] and found[0].metrics.defect_rows == 1
    assert pipeline.extract(D.detections(docs), D.cells(docs), prefer_table=False).first().defects == []


def test_command_line(spark, folder, monkeypatch):
    monkeypatch.setenv("LOG_DIR", str(folder / "logs"))
    out = folder / "out"
    assert cli.main(["--batch", str(folder / "in"), "--output", str(out)]) == 1  # a file is broken
    (found,) = out.glob("batch_summary_*.json")
    summary = json.loads(found.read_text())
    assert {k: summary["batch_info"][k] for k in ("total_files", "successful", "failed")} == {"total_files": 3, "successful": 1, "failed": 2}
    files = {f["doc_id"]: f for f in summary["file_results"]}
    assert files["good-texts.json"]["required_fields"]["act_number"]["value"] == "057/25" and files["bad-texts.json"]["error"] == "Invalid JSON"
    assert files["bad-texts.json"]["required_fields"]["act_number"] == {"value": None, "confidence": 0.0, "suspicious": False}
    assert sorted(p.name for p in out.iterdir() if not p.name.startswith("batch")) == ["good-corrected.json", "good-data.json"]
    fixed = json.loads((out / "good-corrected.json").read_text())
    assert [d["text"] for d in fixed["ocr_results_by_region"]["header"]] == ["Номер", "057I25", "Дата"] and fixed["table_data_by_region"]["defects"]["cells"]
    assert json.loads((out / "good-data.json").read_text())["header"]["act_number"]["value"] == "057/25"
    assert cli.main(["--file", str(folder / "in/good-texts.json"), "--output", str(folder / "out2"), "--mode", "correction"]) == 0
    assert cli.main(["--batch", str(folder / "nothing")]) == 1 and cli.main([]) == 0
    assert cli.main(["--batch", str(folder / "in"), "--mode", "ocr", "--output", str(folder / "out3")]) == 1
    assert "no page images" in (folder / "logs" / "formloom.log").read_text()


def test_corrected_file_holds_flat_and_region_texts(spark, folder):
    doc = document([("Homep", 0.9, 10, 10)])
    doc["text_regions"] = [{"text": t, "confidence": c, "bbox": [[0, 0], [4, 0], [4, 4], [0, 4]], "center": [2, 2]} for t, c in (("Homep", 0.9), ("", 0.9), ("12", 0.2))]
    (folder / "in" / "one-texts.json").write_text(json.dumps(doc))
    docs = D.documents(spark, str(folder / "in/one-texts.json"))
    from formloom.plans import assemble

    row = assemble.validated(assemble.corrected(docs)).first()
    assert [(d.text, d.corrected, d.original_text) for d in row.text_regions] == [("Номер", True, "Homep"), ("", False, None), ("12", False, None)]
    assert row.ocr_results_by_region["header"][0].text == "Номер" and row.corrections_applied["count"] == 1  # the map is corrected, its texts are not logged
    log = row.corrections_applied.corrections[0]
    assert (log["index"], log.original, log.corrected, log.position) == (0, "Homep", "Номер", [2, 2])
    v = row.validation_results
    assert (v.total_fields, v.validated_fields, v.failed_validations, [w["index"] for w in v.low_confidence_warnings]) == (3, 2, 0, [2])


def test_numbers_of_detections_run_through_all_regions(spark, folder):
    doc = document([("a", 0.9, 1, 1), ("b", 0.9, 1, 1)])
    doc["ocr_results_by_region"]["analysis"] = [{"text": "c", "confidence": 0.5, "bbox": [[0, 0], [1, 1]], "center": [0, 0]}]
    (folder / "in" / "two-texts.json").write_text(json.dumps(doc))
    rows = D.detections(D.documents(spark, str(folder / "in/two-texts.json"))).orderBy("det_idx").collect()
    assert [(r.det_idx, r.region_id, r.text) for r in rows] == [(0, "analysis", "c"), (1, "header", "a"), (2, "header", "b")]


def test_stream_gives_what_the_batch_gives(spark, folder):
    got = []
    q = files.extract_stream(files.document_stream(spark, str(folder / "in"), 1), lambda df, _: got.extend(df.collect()), str(folder / "check"))
    q.processAllAvailable()
    q.stop()
    docs = D.documents(spark, str(folder / "in"))
    assert [str(r) for r in got] == [str(r) for r in pipeline.extract(D.detections(docs), D.cells(docs)).collect()]


def test_templates_and_settings(spark, tmp_path):
    assert templates.parse_templates("broken") == templates.DEFAULTS
    own = templates.parse_templates('{"t": [{"region_id": "a", "y_start_norm": 0, "y_end_norm": 0.5}, {"region_id": "b", "y_start_norm": 0.9, "y_end_norm": 0.5}]}')
    assert own == {"t": [("a", 0.0, 0.5)]}
    rows = templates.bands(templates.template(spark, "unknown"), F.lit(100)).collect()
    assert [(r.band, r.y_start, r.y_end) for r in rows] == [("header", 0, 33), ("defects", 33, 66), ("analysis", 66, 100)]
    assert tables.columns(spark, "nothing").count() == 0
    assert settings.load({"GAMMA_CORRECTION": "0.5", "enable_deskew": "false"}).gamma_correction == 0.5
    assert settings.load({"REGION_DETECTION_STRATEGY": "template", "BINARIZATION_MODE": "adaptive"}).region_detection_strategy == "template"
    wrong = {"illumination_kernel": "30", "ILLUMINATION_KERNEL": "13", "binarization_mode": "other", "region_min_header_ratio": "1.5", "perspective_corner_epsilon": "0", "perspective_min_corner_distance": "0"}
    for name, value in wrong.items():
        with pytest.raises(ValueError):
            settings.load({name: value})
    (tmp_path / ".env").write_text("# a comment\nTEMPLATE_NAME='otk_v2'\nocr_pool_size=3\n")
    assert settings.load({}, str(tmp_path / ".env")).template_name == "otk_v2"
    own_file = tmp_path / "regions.json"
    own_file.write_text('{"mine": [{"region_id": "all", "y_start_norm": 0, "y_end_norm": 1}]}')
    assert templates.load_templates(spark, str(own_file)) == {"mine": [("all", 0.0, 1.0)]} and templates.load_templates(spark, str(tmp_path / "none.json")) == templates.DEFAULTS


def test_documents_are_put_together_again(spark):
    from formloom.plans import assemble

    page = [det("Homep", 10, 10), det("", 20, 20), det("100", 30, 30, 0.4), det("x", 40, 40, 0.2, "defects")]
    checked, _ = pipeline.corrected_and_validated(frame(spark, a=page))
    d = assemble.documents(checked).first()
    assert [t.text for t in d.text_regions] == ["Номер", "", "100", "x"] and d.corrections_applied["count"] == 1
    assert {k: len(v) for k, v in d.ocr_results_by_region.items()} == {"header": 3, "defects": 1}
    v = d.validation_results
    assert (v.total_fields, v.validated_fields, v.failed_validations, len(v.low_confidence_warnings)) == (4, 3, 0, 2)
    assert d.processing_metrics.low_confidence_count == 2 and d.text_regions[0].bbox == [[-20, -10], [40, -10], [40, 30], [-20, 30]]
