from orderlens.streaming.scoring import score_stream  # noqa: F401
