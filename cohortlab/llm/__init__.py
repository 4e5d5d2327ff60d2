"""Training-data operators: chat parsing, SentencePiece, quality, WARC, vector and text near-duplicates,
mixing, toxicity, personal data, fingerprints, whitening, quality rules and the Merkle manifest. Nothing outside this subpackage imports it."""
