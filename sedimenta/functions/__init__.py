from sedimenta.functions.numeric import money_sum, round2, safe_number

__all__ = [ "money_sum", "round2", "safe_number"]
