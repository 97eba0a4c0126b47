"""Column builders: text folding, geo, time, URLs, HTML."""
