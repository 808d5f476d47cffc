"""Operations of a training-data pipeline: filtering, deduplication, mixing, extraction and encoding of text."""
