"""Operations of a training-data pipeline over documents, embeddings and pages; nothing else in the library imports them."""
