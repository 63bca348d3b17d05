class ContractError(ValueError):
    """A contract, or data that cannot be read under it."""
