"""Writers: catalog tables, load strategies, audit log."""
