"""Reading: files, documents, sheets, extracts and constant rows; and writing them back."""
