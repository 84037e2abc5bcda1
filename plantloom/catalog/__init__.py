"""Named queries over the driver's tables, each with SQL to check it by."""
