"""Kernels and page operators on drawn pages."""

import struct
import zlib

import numpy as np
import pytest

from formloom.sources import images
from formloom.sources.settings import Settings
from formloom.vision import kernels as K
from formloom.vision import pages as P

S = Settings()


def ruled(height=2000, width=1500, lines=(440, 1200)):
    page = np.full((height, width), 255, np.uint8)
    for y in range(60, height - 60, 50):
        if min(abs(y - line) for line in lines) > 30:
            page[y : y + 12, 100 : width - 100 : 3] = 0
    for y in lines:
        page[y - 1 : y + 2, 50 : width - 50] = 0
    return page


def table(rows=5, columns=4):
    page = np.full((400, 600), 255, np.uint8)
    for y in np.linspace(10, 390, rows).astype(int):
        page[y - 1 : y + 2, 5:595] = 0
    for x in np.linspace(10, 590, columns).astype(int):
        page[5:395, x - 1 : x + 2] = 0
    return page


def test_zones_follow_the_lines():
    bands = P.zones(ruled(), S, "otk_v2")
    assert [(b[0], b[3]) for b in bands] == [("header", "adaptive"), ("defects", "adaptive"), ("analysis", "adaptive")]
    assert bands[0][2] == 440 and bands[1][2] == 1200 and bands[2][2] == 2000


def test_zones_of_an_empty_page_are_the_templates():
    assert [b[3] for b in P.zones(np.full((600, 400), 255, np.uint8), Settings(region_detection_strategy="template"))] == ["template"] * 3


def test_grid_and_cells():
    found = P.grid(table(), S)
    assert len(found["rows"]) == 5 and len(found["cols"]) == 4 and 0 < found["confidence"] <= 1
    assert P.grid(np.full((400, 600), 255, np.uint8), S) is None and P.grid(np.zeros((20, 20), np.uint8), S) is None
    boxes = P.cell_boxes({"rows": [0, 100, 200], "cols": [0, 300]}, 600, 200, S)
    assert boxes[0] == (0, 0, 2, 2, 148, 48) and len(boxes) == 6


def test_empty_cells():
    blank, text = np.full((40, 120), 255, np.uint8), np.full((40, 120), 255, np.uint8)
    text[10:30, 20:100:4] = 0
    assert P.is_empty(blank, S) and P.is_empty(blank[:0], S) and not P.is_empty(text, S)
    assert not P.is_empty(np.random.default_rng(0).integers(0, 256, (40, 120), dtype=np.uint8), S)


def test_skew_is_undone():
    page = np.full((600, 800), 255, np.uint8)
    for y in (150, 300, 450):
        page[y : y + 4, 60:740] = 0
    turned = K.rotate(page, 5)
    back, angle = P.deskew(turned)
    assert abs(abs(angle) - 5) <= 1 and K.lines(back < 128, 300, 400)
    assert P.deskew(page)[1] == 0.0


def test_perspective():
    page = np.zeros((800, 1000), np.uint8)
    quad = np.array([[200, 100], [800, 150], [850, 700], [150, 650]], float)
    y, x = np.mgrid[0:800, 0:1000]
    inside = np.ones(page.shape, bool)
    for p, q in zip(quad, np.roll(quad, -1, axis=0)):
        inside &= (q[0] - p[0]) * (y - p[1]) - (q[1] - p[1]) * (x - p[0]) >= 0
    page[inside] = 250
    flat = P.straighten(page, S)
    assert flat.shape != page.shape and (flat > 200).mean() > 0.97
    plain = np.full((300, 300), 200, np.uint8)
    assert P.straighten(plain, S).shape == plain.shape


@pytest.mark.parametrize("window", [1, 4, 5])
def test_smoothing_pads_with_zeros(window):
    v = np.arange(9.0)
    padded = np.pad(v, window)
    want = [padded[window + i - window // 2 : window + i - window // 2 + window].sum() / window for i in range(9)]
    assert np.allclose(K.smooth(v, window), want)


def test_components_touch_by_corners():
    m = np.array([[1, 0, 0, 1], [0, 1, 0, 0], [0, 0, 0, 0], [1, 1, 0, 1]], bool)
    assert sorted(map(tuple, K.components(m).tolist())) == [(0, 0, 2, 2), (0, 3, 2, 4), (3, 0, 4, 1), (3, 3, 4, 4)]


def png(image):
    h, w = image.shape
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    rows = b"".join(b"\x00" + r.tobytes() for r in image)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def test_images_as_rows(spark, tmp_path):
    (tmp_path / "a.PNG").write_bytes(png(ruled(400, 300, (90, 240))))
    (tmp_path / "b.png").write_bytes(b"junk")
    (tmp_path / "c.txt").write_text("no image")
    small = Settings(enable_adaptive_scaling=False, enable_perspective_correction=False)
    assert images.image_files(spark, str(tmp_path)).count() == 2
    read = images.images(spark, str(tmp_path))
    rows = {r.origin[-5:]: (r.status, r.error, r.height) for r in P.preprocessed(read, small).collect()}
    assert rows == {"a.PNG": ("ok", None, 400), "b.png": ("failed", "Unable to read image", None)}
    assert P.zoned(read, small).count() == 3
    known = P.replay({("a.PNG", "defects"): [("текст", 0.9, 10, 10, 50, 20), ("faint", 0.2, 0, 0, 1, 1)]})
    found = P.recognised(read, known, small).collect()
    assert [(f.text, f.region_id, f.y0 - min(z.y_start for z in P.zoned(read, small).collect() if z.region_id == "defects")) for f in found] == [("текст", "defects", 10)]


def test_cells_of_a_page(spark, tmp_path):
    page = ruled(1200, 600, (264, 720))
    page[264:720] = 255
    for y in (264, 400, 550, 700):
        page[y - 1 : y + 2, 10:590] = 0
    for x in (15, 200, 400, 585):
        page[264:701, x - 1 : x + 2] = 0
    page[430:520:4, 110:280] = 0
    (tmp_path / "a.png").write_bytes(png(page))
    s = Settings(region_detection_strategy="template", template_name="otk_v2")
    read = images.images(spark, str(tmp_path))
    cells = P.recognised_cells(read, lambda origin, place, pixels: [("x", 0.5, 0, 0, 1, 1), ("y", 0.7, 0, 0, 1, 1)], s).collect()
    bands = {b[0]: b for b in P.zones(page, s)}
    found = P.grid(page[bands["defects"][1] : bands["defects"][2]], s)
    assert found is None or len(cells) == len(P.cell_boxes(found, 600, bands["defects"][2] - bands["defects"][1], s))
    assert {c.text for c in cells} <= {"", "x y"}
    for c in cells:
        assert (c.text, round(c.confidence, 6)) in {("", 1.0), ("x y", 0.6)}


def test_command_line_over_images(spark, tmp_path, monkeypatch):
    import json

    from formloom.plans import cli
    from formloom.sources import png as files
    from formloom.sources.drawn import page

    monkeypatch.setenv("LOG_DIR", str(tmp_path / "logs"))
    for name, value in (("TEMPLATE_NAME", "otk_v2"), ("TABLE_CELL_PREPROCESS", "false"), ("ENABLE_ADAPTIVE_SCALING", "false"), ("ENABLE_PERSPECTIVE_CORRECTION", "false")):
        monkeypatch.setenv(name, value)
    (tmp_path / "in").mkdir()
    for k in (1, 2):
        (tmp_path / "in" / f"form{k}-cor.png").write_bytes(files.encode(page(k)))
    run = lambda *args: cli.main(["--batch", str(tmp_path / "in"), "--output", str(tmp_path / "out"), *args])
    assert run("--mode", "ocr") == 1 and run("--mode", "batch", "--recogniser", "nothing") == 1
    assert run("--mode", "batch", "--recogniser", "dots") == 0
    names = sorted(p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith("batch_summary"))
    assert names == ["form1-corrected.json", "form1-data.json", "form1-texts.json", "form2-corrected.json", "form2-data.json", "form2-texts.json"]
    text = json.loads((tmp_path / "out" / "form1-texts.json").read_text())
    assert text["document_info"]["image_height"] == 1210 and text["document_info"]["ocr_engine"] == "dots" and len(text["regions_detected"]) == 3
    assert {d["region_id"] for d in text["text_regions"]} == {"header", "defects", "analysis"} and text["table_data_by_region"]["defects"]["grid"]["num_cols"] == 4
    (found,) = (tmp_path / "out").glob("batch_summary_*.json")
    files_ = json.loads(found.read_text())["file_results"]
    assert all(f["status"] == "ok" and f["seconds"] > 0 and f["texts_found"] > 6 for f in files_)
    (tmp_path / "in" / "junk.png").write_bytes(b"junk")
    assert run("--mode", "ocr", "--recogniser", "dots") == 1
    assert cli.main(["--file", str(tmp_path / "in" / "form1-cor.png"), "--mode", "preprocess", "--output", str(tmp_path / "pages")]) == 0
    assert files.decode((tmp_path / "pages" / "form1-cor-cor.png").read_bytes()).shape == (1210, 800)


def test_recognisers_by_name_and_their_forms(tmp_path):
    from formloom.vision import recognisers as R

    with pytest.raises(ValueError):
        R.make("nothing")
    box = [[1, 2], [5, 2], [5, 9], [1, 9]]
    want = [("a", 0.5, 1, 2, 5, 9)]
    assert R.normalised([("a", 0.5, 1, 2, 5, 9)]) == want
    assert R.normalised([{"rec_texts": ["a", "b"], "rec_scores": [0.5], "rec_polys": [box, box]}]) == want
    assert R.normalised([[[box, ("a", 0.5)], [box, None], None, [[], ("x", 1)]]]) == want
    assert R.normalised(None) == R.normalised([]) == R.normalised([None]) == []
    (tmp_path / "r.json").write_text('{"a.png": {"header": [["x", 0.9, 0, 0, 1, 1]]}}')
    named = R.Named(f"replay:{tmp_path}/r.json")
    assert R.normalised(named("file:/in/a.png", "header", None)) == [("x", 0.9, 0, 0, 1, 1)] and R.normalised(named("b.png", "header", None)) == []
    named.close()


def test_failures_are_retried_smaller_and_then_rows(spark, tmp_path):
    from formloom.sources import png as files
    from formloom.sources.drawn import page

    (tmp_path / "a.png").write_bytes(files.encode(page(0)))
    read = images.images(spark, str(tmp_path))
    s = Settings(template_name="otk_v2", enable_table_detection=False)

    def picky(origin, region, pixels):
        if pixels.shape[1] > 400:
            raise RuntimeError("too large")
        return [("t", 0.9, 10, 10, 20, 20)]

    rows = P.recognised(read, picky, s).collect()
    assert {(r.x0, r.x1) for r in rows} == {(20, 40)} and len(rows) == 3  # read at half the size, boxes scaled back

    def broken(origin, region, pixels):
        raise RuntimeError("never")

    row = P.read_pages(read, broken, s, prepare=False).first()
    assert (row.status, row.error) == ("failed", "never") and row.seconds > 0


def test_adaptive_binarisation_and_solid_pages():
    image = np.full((120, 160), 180, np.uint8)
    image[:, 80:] = 90
    image[40:50, 20:60], image[40:50, 100:140] = 120, 30
    black = P.enhance(image, Settings(binarization_mode="adaptive", enable_adaptive_scaling=False)) == 0
    assert black[40:50, 25:55].mean() > 0.5 and black[40:50, 105:135].mean() > 0.5 and black[90:, 10:60].mean() < 0.2
    bay = np.zeros((400, 400), np.uint8)
    bay[50:350, 50:350] = 250
    bay[50:260, 120:350] = 0  # an L: its hull has corners that the page has not
    assert P.straighten(bay, S).shape == bay.shape
    assert np.allclose(K.gaussian(np.full((9, 9), 7.0), 5), 7)
