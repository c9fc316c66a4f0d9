"""Rows with every difficulty: nulls, empty and long texts, repeats, extra
columns whose names the operators use inside."""

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, tag string, chunk string, h int, "
          "place string, node string, band string, recipe string, size string, target string, score string, "
          "_row string, _keep string, kinds string, found string")


def rows(texts):
    """(doc_id, text[, source]) -> whole rows."""
    out = []
    for r in texts:
        doc_id, text = r[:2]
        source = r[2] if len(r) > 2 else "s"
        out.append((doc_id, text, None, source, None, "x", "x", 7, "x", "x", "x", "x", "x", "x", "x", "x", "x", "x", "x"))
    return out


def frame(spark, texts, parts=3):
    return spark.createDataFrame(rows(texts), SCHEMA).repartition(parts)
