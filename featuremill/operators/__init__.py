"""Frame-level operators shared by the table builders."""
