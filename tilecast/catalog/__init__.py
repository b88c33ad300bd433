"""Named queries over the demand table, and the SQL each must agree with."""
