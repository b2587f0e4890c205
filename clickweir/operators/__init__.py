"""DataFrame-to-DataFrame operators; all but the row limits also run on streams."""
