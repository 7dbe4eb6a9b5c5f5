"""Operations of a training-data pipeline over text tables.

Thirteen operators, one module each, plus ``queries`` (the thin registered
queries) and ``common`` (staging, file output).  Nothing else in the
library imports this subpackage.

| N | module | operator |
| --- | --- | --- |
| 1 | ``pieces`` | SentencePiece encoding and decoding by a merge agenda |
| 2 | ``hamming_index`` | nearest neighbours by multi-index hashing |
| 3 | ``repeats`` | repeated-passage removal behind a count-min prefilter |
| 4 | ``chatlog`` | event-sourced chat formatting |
| 5 | ``copies`` | exact dedup with a heavy-hitter split |
| 6 | ``wavelet`` | token ids in one wavelet-matrix file per shard |
| 7 | ``simhash`` | SimHash near-dedup over a byte-position index |
| 8 | ``quality`` | regularised quadratic discriminant |
| 9 | ``mixing`` | soft-membership mixing to target weights |
| 10 | ``warc`` | dictionary-compressed WARC archives |
| 11 | ``packing`` | least-squares packing into token windows |
| 12 | ``divergence`` | audit of how sources differ in their words |
| 13 | ``merkle`` | content-addressed Merkle manifest |
"""
