"""A small table with the hard cases: nulls, empty and very long texts, ties, repeated rows, extra
columns whose names clash with the operators' own."""

LONG = " ".join(f"w{i % 997}x{i}" for i in range(20_000)) + " " + "z" * 50_000

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, n_tokens string, "
          "row string, kept string, component_id string, carried string, host string, key string")


def documents(spark, texts, sources=None, langs=None):
    rows = [(i if t != "NOID" else None, None if t == "NULL" else t,
             langs[i] if langs else "en", sources[i] if sources else None, None, "x", None, "x",
             None, "x", None, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


HARD = ["NULL", "", " \t\n", "one two three", "one two three", "NOID", LONG, LONG,
        "Ünïcode ſtraße 漢字   x  y\n\n z", "a<|endoftext|>b", "...!!!???"]
